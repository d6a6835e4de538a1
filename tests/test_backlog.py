"""Commits of several runs at once, deltas and log layers."""

from datetime import timedelta
from pathlib import Path

import pytest
from data import KINDS, START, history, observations, run_log
from model import play

from pyspark.sql import functions as F

from shelfdiff.functions.times import as_utc
from shelfdiff.plans.run import commit_runs, run_snapshot
from shelfdiff.schema import CHANGES, LISTING, RUN_LOG
from shelfdiff.sources import layers as ly
from shelfdiff.sources import layered as rows_of
from shelfdiff.sources.tables import Store
from shelfdiff.streaming.runs import commit_arrivals

HOUR = timedelta(hours=1)


def state_of(store, site):
    changes = store.changes().filter(F.col("site") == site)
    log = store.run_log().filter(F.col("site") == site)
    found = (store.listing(site).select(*LISTING.names), changes.select(*CHANGES.names), log.select(*RUN_LOG.names))
    return [sorted(map(repr, x.collect())) for x in found]


def announced(errors):
    return [{"run_ts": as_utc(ts), "error": e, "page": 1, "count": 3} for ts, e in sorted(errors.items())]


@pytest.mark.parametrize("kind", KINDS)
def test_a_backlog_equals_its_runs_one_by_one(spark, kind, tmp_path):
    profile = KINDS[kind]
    rows, errors = history(12, n_runs=7, n_items=7, hours=20)
    expected, _ = play(kind, rows, errors)
    seen = observations(spark, profile.site, rows).cache()
    runs = announced(errors)
    single, split = (Store(spark, f"{tmp_path}/{name}") for name in ("single", "split"))
    for run in runs:
        own = single.open_run(profile.site, run["run_ts"], run["error"])
        snapshot = seen.filter(F.col("run_ts") == F.lit(run["run_ts"]))
        run_snapshot(single, snapshot, profile, own, 1, 3, commit=True)
    split.write_snapshot(seen)
    for part in (runs[:3], runs[3:4], runs[4:]):
        commit_runs(split, profile, part)
    assert state_of(split, profile.site) == state_of(single, profile.site)
    assert split.changes().count() == len(expected)
    # As of any run, inside a backlog too.
    for run in (runs[1], runs[5]):
        one, other = (s.version(profile.site, run["run_ts"]) for s in (single, split))
        assert sorted(map(repr, one.select(*LISTING.names).collect())) == sorted(map(repr, other.select(*LISTING.names).collect()))
    seen.unpersist()


def test_all_sites_of_a_batch_and_a_null_count(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    profiles = {p.site: p for p in KINDS.values()}
    rows, errors = history(5, n_runs=3)
    arrivals = None
    for p in profiles.values():
        store.write_snapshot(observations(spark, p.site, rows))
        own = run_log(spark, p.site, errors).select("site", "run_ts", "error", "page", "count")
        arrivals = own if arrivals is None else arrivals.unionByName(own)
    commit_arrivals(arrivals, store, profiles, "shop/4")
    assert store.run_log().groupBy("site").count().collect() and store.run_log().count() == 9
    assert {r["batch"] for r in store.batches().collect()} == {"shop/4"}
    before = {s: state_of(store, s) for s in profiles}
    # Announced without a count and not landed: no reason to take everything as sold.
    later = arrivals.filter(F.col("run_ts") == F.lit(max(errors))).withColumn("run_ts", F.col("run_ts") + F.expr("interval 1 day"))
    with pytest.raises(ValueError, match="unknown number of items"):
        commit_arrivals(later.withColumn("count", F.lit(None).cast("bigint")), store, profiles)
    assert {s: state_of(store, s) for s in profiles} == before
    commit_arrivals(later.withColumn("count", F.lit(0).cast("bigint")), store, profiles)
    assert store.run_log().count() == 12


def listing_rows(n, ts):
    return [{"ts": ts, "item": f"i{k:05d}", "price": k, "title": f"t{k}"} for k in range(n)]


def test_a_commit_writes_what_its_snapshot_touches(spark, tmp_path):
    profile = KINDS["status"]
    store = Store(spark, str(tmp_path), new_buckets=4)
    snapshots = [listing_rows(5000, START)] + [listing_rows(5000, START + HOUR * n)[:20] for n in (1, 2)]
    for rows in snapshots:
        run = store.open_run(profile.site, rows[0]["ts"])
        run_snapshot(store, observations(spark, profile.site, rows), profile, run, commit=True)
    layers = store._listing(profile.site).all()
    written = {x.first: spark.read.parquet(x.path).count() for x in layers}
    assert list(written.values()) == [5000, 20, 20]
    assert store.listing(profile.site).count() == 5000
    # One file for a small commit, whatever the number of buckets.
    small = [x for x in layers if written[x.first] == 20]
    assert all(len(spark.read.parquet(x.path).inputFiles()) == 1 for x in small)


def test_deltas_are_folded_and_read_alike(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rows_of, "FOLD", 3)
    profile = KINDS["status"]
    store = Store(spark, str(tmp_path), new_buckets=4)
    store.write_version(spark.createDataFrame([], LISTING), profile.site, START - HOUR)
    kinds = []
    for n in range(7):
        rows = [{"ts": START + HOUR * n, "item": f"i{k}", "price": n} for k in range(n, n + 3)]
        run = store.open_run(profile.site, rows[0]["ts"])
        run_snapshot(store, observations(spark, profile.site, rows), profile, run, commit=True)
        kinds.append(sorted(x.kind for x in store._listing(profile.site).all()))
    assert "fold" in sum(kinds, []) or kinds[-1].count("base") > 1
    state = {r["item_id"]: (r["price"], r["update_ts"]) for r in store.listing(profile.site).collect()}
    assert state == {f"i{k}": (min(k, 6), START + HOUR * min(k, 6)) for k in range(9)}
    assert store.fold(profile.site, base=False) in ("fold", None)
    assert store.fold(profile.site, base=True) in ("base", None)
    assert {r["item_id"]: (r["price"], r["update_ts"]) for r in store.listing(profile.site).collect()} == state
    assert store.version(profile.site, START + HOUR).count() == 4
    assert store.run_log().count() == 7


def test_an_unfinished_commit_is_not_read_and_goes(spark, tmp_path):
    profile = KINDS["status"]
    store = Store(spark, str(tmp_path), new_buckets=2)
    for n, price in ((0, 5), (2, 7)):
        rows = observations(spark, profile.site, [{"ts": START + HOUR * n, "item": "x", "price": price}])
        run = store.open_run(profile.site, START + HOUR * n)
        run_snapshot(store, rows, profile, run, commit=True)
        lost = store.listing(profile.site).withColumns({"price": F.lit(99).cast("long"), "found": F.lit(None)})
        store.write_delta(lost.withColumn("update_ts", F.lit(START + HOUR * (n + 1))), profile.site, START + HOUR * (n + 1))
        assert store.listing(profile.site).first()["price"] == price
    names = [x.last for x in store._listing(profile.site).all()]
    assert len(names) == 3  # the first unfinished one is gone


def test_one_item_is_found_in_one_bucket(spark, tmp_path):
    profile = KINDS["presence"]
    store = Store(spark, str(tmp_path), new_buckets=8)
    run = store.open_run(profile.site, START)
    rows = observations(spark, profile.site, listing_rows(400, START))
    run_snapshot(store, rows, profile, run, commit=True)
    store.fold(profile.site, base=True)
    late = observations(spark, profile.site, [{"ts": START + HOUR, "item": "i00007", "price": 1}])
    run_snapshot(store, late, profile, store.open_run(profile.site, START + HOUR), commit=True)
    base = next(x for x in store._listing(profile.site).all() if x.kind == "base")
    files = [str(f) for f in Path(base.path).glob("part-*.parquet")]
    others = [f for f in files if spark.read.parquet(f).filter("item_id = 'i00005'").isEmpty()]
    assert len(files) == 8 and len(others) == 7
    for f in others:
        Path(f).write_bytes(b"not a table")
    found = store.find_item(profile.site, "i00005")
    assert [(r["item_id"], r["price"]) for r in found.collect()] == [("i00005", 5)]
    with pytest.raises(Exception, match="not a Parquet file"):
        store.listing(profile.site).collect()
    assert store.find_item("other", "i00007").isEmpty()


def test_a_long_log_opens_a_run_without_reading_it(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.range(10_000).select(
        F.lit("s").alias("site"),
        (F.lit(START) + F.make_interval(hours=F.col("id").cast("int"))).alias("run_ts"),
        (F.col("id") % 3 == 2).cast("long").alias("error"),
        *[F.lit(0).alias(c) for c in ("page", "count", "new", "discount", "sold")],
    )
    store.append_log(rows)
    tail = START + HOUR * 10_000
    for n in range(3):
        run = store.open_run("s", tail + HOUR * n, 1)
        store.append_log(run_log(spark, "s", {tail + HOUR * n: 1}), run)
    tracker, group = spark.sparkContext.statusTracker(), "open-run"
    spark.sparkContext.setJobGroup(group, group)
    run = store.open_run("s", tail + HOUR * 5)
    assert not tracker.getJobIdsForGroup(group)
    assert (run.last, run.newest) == (as_utc(START + HOUR * 9999), as_utc(tail + HOUR * 2))
    assert store.open_run("s", START + HOUR * 8).last == as_utc(START + HOUR * 7)
    assert store.open_run("s", START + HOUR * 9).last == as_utc(START + HOUR * 7)
    assert store.run_log().count() == 10_003


def test_log_layers_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rows_of, "FOLD", 4)
    store = Store(spark, str(tmp_path))
    for n in range(10):
        run = store.open_run("s", START + HOUR * n, n % 2)
        store.append_log(run_log(spark, "s", {START + HOUR * n: n % 2}), run)
        assert store.run_log().count() == n + 1
    assert len(ly.widest(ly.all_layers(spark, store._log_folder("s")))) < 4
    assert len(store.run_log().inputFiles()) < 4
