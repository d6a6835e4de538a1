"""Run by run against stored state: equals the model, the replay and a repeat of itself."""

from datetime import datetime, timedelta

import pytest
from data import KINDS, START, change_rows, history, observations, run_log
from model import play

from pyspark.sql import functions as F

from shelfdiff import dedup_first, detect, listing_state, merge, open_run
from shelfdiff.functions.times import as_utc
from shelfdiff.plans.run import run_snapshot
from shelfdiff import replay
from shelfdiff.operators.replay import item_sequence
from shelfdiff.schema import LISTING
from shelfdiff.sources.tables import Store
from shelfdiff.streaming.runs import commit_arrivals


@pytest.mark.parametrize("kind", KINDS)
def test_committing_run_by_run_equals_the_model(spark, kind, tmp_path):
    profile = KINDS[kind]
    rows, errors = history(1, n_runs=6, n_items=6, hours=20)
    expected, state = play(kind, rows, errors)
    store = Store(spark, str(tmp_path))
    seen = observations(spark, profile.site, rows)
    found = []
    for ts in sorted(errors):
        run = open_run(store.run_log(), profile.site, ts, errors[ts])
        snapshot = seen.filter(F.col("run_ts") == F.lit(ts))
        preview = run_snapshot(store, snapshot, profile, run)
        before = store.run_log().count()
        previewed = change_rows(preview.changes)
        assert store.run_log().count() == before
        result = run_snapshot(store, snapshot, profile, run, page=1, count=3, commit=True)
        assert change_rows(result.changes) == previewed
        found += previewed
    assert sorted(found, key=repr) == sorted(expected, key=repr)

    rebuilt = listing_state(seen, [profile]).select(*LISTING.names).collect()
    assert sorted(map(repr, store.listing(profile.site).collect())) == sorted(map(repr, rebuilt))
    assert len(rebuilt) == len(state)

    log = {r["run_ts"]: r for r in store.run_log().collect()}
    for ts in errors:
        kinds = [c[1] for c in expected if c[0] == ts]
        row = log[ts]
        assert (row["new"], row["discount"], row["sold"]) == (
            kinds.count("new"),
            kinds.count("discount"),
            kinds.count("sold") + kinds.count("bid"),
        )


@pytest.mark.parametrize("kind", KINDS)
def test_large_snapshots_take_the_sort_merge_path(spark, kind):
    profile = KINDS[kind]
    rows, errors = history(9, n_items=15)
    log = run_log(spark, profile.site, errors)
    seen = observations(spark, profile.site, rows)
    newest = max(errors)
    for error in (0, 1):
        run = open_run(log, profile.site, newest, error)
        snapshot = seen.filter(F.col("run_ts") == F.lit(newest))
        listing = listing_state(seen.filter(F.col("run_ts") < F.lit(newest)), [profile])
        small = detect(snapshot, listing, run, profile)
        large = detect(snapshot, listing, run, profile, broadcast_rows=0)
        assert change_rows(small) == change_rows(large)
        assert change_rows(small)


LAST, NOW = START + timedelta(days=2), START + timedelta(days=3)
TICK, DAY = timedelta(microseconds=1), timedelta(days=1)
SAME = {"price": 100, "full": 100, "num": 0, "onsale": 1}

# (stored row, row now or None, kinds found), per profile and error count
TRAPS = {
    ("presence", 0): [
        # seen exactly at the last clean run is not new, a microsecond earlier is
        ({"ts": LAST}, {}, []),
        ({"ts": LAST - TICK}, {}, ["new"]),
        # equal and NULL prices are no drops; a stale item can be in two sets
        ({"ts": LAST, "price": None}, {"price": 50}, []),
        ({"ts": LAST}, {"price": None}, []),
        ({"ts": LAST - TICK}, {"price": 99}, ["discount", "new"]),
        # absence counts once
        ({"ts": LAST}, None, ["sold"]),
        ({"ts": LAST - TICK}, None, []),
    ],
    ("presence", 1): [({"ts": LAST}, None, []), ({"ts": LAST}, {"price": 99}, ["discount"])],
    ("status", 0): [
        ({"ts": LAST}, None, []),
        ({"ts": LAST, "onsale": 0}, {}, ["new"]),
        ({"ts": LAST}, {"onsale": 0, "price": 1}, ["sold"]),
        ({"ts": LAST, "onsale": 0}, {"onsale": 0}, []),
        ({"ts": LAST}, {"price": 99}, ["discount"]),
    ],
    ("auction", 0): [
        ({"ts": LAST}, None, []),
        # a day of grace
        ({"ts": LAST - DAY}, {}, []),
        ({"ts": LAST - DAY - TICK}, {}, ["new"]),
        # zero is a price
        ({"ts": LAST}, {"full": 0}, ["discount"]),
        # a stored bid hides drops; a risen count is a bid
        ({"ts": LAST, "num": 1}, {"price": 50, "num": 1}, []),
        ({"ts": LAST}, {"price": 50, "num": 2}, ["bid", "discount"]),
    ],
}


@pytest.mark.parametrize("case", TRAPS)
def test_traps(spark, case):
    profile, error = KINDS[case[0]], case[1]
    stored, now = [], []
    for n, (old, new, _) in enumerate(TRAPS[case]):
        stored.append({**SAME, **old, "item": f"i{n}"})
        if new is not None:
            now.append({**SAME, **new, "item": f"i{n}", "ts": NOW})
    listing = listing_state(observations(spark, profile.site, stored), [profile])
    snapshot = observations(spark, profile.site, now)
    run = open_run(run_log(spark, profile.site, {LAST: 0}), profile.site, NOW, error)
    found = {f"i{n}": [] for n in range(len(TRAPS[case]))}
    for r in detect(snapshot, listing, run, profile).collect():
        found[r["item_id"]].append(r["kind"])
    expected = {f"i{n}": kinds for n, (_, _, kinds) in enumerate(TRAPS[case])}
    assert {i: sorted(kinds) for i, kinds in found.items()} == expected


def test_first_seen_already_sold_is_sold(spark):
    profile = KINDS["status"]
    snapshot = observations(spark, profile.site, [{"ts": START, "item": "x", "onsale": 0, "price": 1}])
    log = run_log(spark, profile.site, {START - timedelta(days=1): 0})
    listing = spark.createDataFrame([], LISTING)
    run = open_run(log, profile.site, START)
    assert [r["kind"] for r in detect(snapshot, listing, run, profile).collect()] == ["sold"]


def test_faulty_runs_do_not_move_the_last_clean_run(spark):
    site = KINDS["presence"].site
    day = timedelta(days=1)
    log = run_log(spark, site, {START: 0, START + day: 1, START + 3 * day: 0})
    run = open_run(log, site, START + 2 * day)
    assert run.last == as_utc(START) and run.newest == as_utc(START + 3 * day) and run.late
    assert open_run(log, site, START).last is None
    assert open_run(log, "other", START).last is None


def test_merge_overwrites_with_null_and_keeps_what_is_stored(spark):
    profile = KINDS["presence"]
    listing = listing_state(
        observations(spark, profile.site, [{"ts": START, "item": "x", "price": 5, "title": None}]),
        [profile],
    )
    later = START + timedelta(days=1)
    snapshot = observations(
        spark, profile.site, [{"ts": later, "item": "x", "price": None, "title": "t", "onsale": 1}]
    )
    run = open_run(run_log(spark, profile.site, {START: 0}), profile.site, later)
    row = merge(listing, snapshot, run, profile).collect()[0]
    assert (row["price"], row["title"], row["onsale"]) == (None, None, None)
    assert (row["record_ts"], row["update_ts"]) == (START, later)


def test_dedup_keeps_the_first_arrival_and_drops_null_ids(spark):
    rows = [
        {"ts": START, "item": "x", "price": 1},
        {"ts": START, "item": "x", "price": 2},
        {"ts": START, "item": None, "price": 3},
        {"ts": START + timedelta(days=1), "item": "x", "price": 4},
    ]
    found = dedup_first(observations(spark, "s", rows)).collect()
    assert sorted((r["item_id"], r["price"]) for r in found) == [("x", 1), ("x", 4)]


def test_late_and_repeated_arrivals_change_nothing(spark, tmp_path):
    profile = KINDS["presence"]
    rows, errors = history(4, n_runs=3)
    store = Store(spark, str(tmp_path))
    store.write_snapshot(observations(spark, profile.site, rows))
    arrivals = run_log(spark, profile.site, errors).select("site", "run_ts", "error", "page", "count")
    commit_arrivals(arrivals, store, {profile.site: profile})
    once = (sorted(map(repr, store.run_log().collect())), store.listing(profile.site).count())
    commit_arrivals(arrivals, store, {profile.site: profile})
    assert (sorted(map(repr, store.run_log().collect())), store.listing(profile.site).count()) == once
    assert store.skipped().isEmpty()
    early = arrivals.limit(1).withColumn("run_ts", F.lit(START - timedelta(days=9)))
    other = arrivals.limit(1).withColumn("site", F.lit("nowhere"))
    commit_arrivals(early.union(other), store, {profile.site: profile})
    assert sorted((r["site"], r["reason"]) for r in store.skipped().collect()) == sorted(
        [(profile.site, "late"), ("nowhere", "unknown site")]
    )
    assert store.run_log().count() == len(errors)


def test_an_unlogged_version_is_not_read(spark, tmp_path):
    profile = KINDS["presence"]
    store = Store(spark, str(tmp_path))
    seen = observations(spark, profile.site, [{"ts": START, "item": "x", "price": 1}])
    run = open_run(store.run_log(), profile.site, START)
    run_snapshot(store, seen, profile, run, commit=True)
    unfinished = merge(
        store.listing(profile.site),
        observations(spark, profile.site, [{"ts": datetime(2024, 2, 1), "item": "y", "price": 1}]),
        run,
        profile,
    )
    store.write_version(unfinished, profile.site, datetime(2024, 2, 1))
    assert [r["item_id"] for r in store.listing(profile.site).collect()] == ["x"]


def test_expired_versions_are_emptied_and_the_newest_stay(spark, tmp_path):
    profile = KINDS["presence"]
    rows, errors = history(4, n_runs=4)
    store = Store(spark, str(tmp_path))
    store.write_snapshot(observations(spark, profile.site, rows))
    arrivals = run_log(spark, profile.site, errors).select("site", "run_ts", "error", "page", "count")
    commit_arrivals(arrivals, store, {profile.site: profile})
    before = sorted(map(repr, store.listing(profile.site).collect()))
    runs = sorted(errors)
    assert store.expire(profile.site, keep=2) == 2
    assert [store.version(profile.site, ts).isEmpty() for ts in runs] == [True, True, False, False]
    assert sorted(map(repr, store.listing(profile.site).collect())) == before
    assert store.expire(profile.site, keep=2, since=runs[2]) == 0


def test_snapshots_are_replaced_run_by_run(spark, tmp_path):
    """Writing one run leaves the others, in a session that knows the folder or not."""
    site = KINDS["status"].site
    store = Store(spark, str(tmp_path))
    day = timedelta(days=1)
    one = [{"ts": START, "item": "x", "price": 1}]
    two = [{"ts": START + day, "item": "x", "price": 2}, {"ts": START + day, "item": "y", "price": 3}]
    store.write_snapshot(observations(spark, site, one))
    store.write_snapshot(observations(spark, "other", one))
    store.write_snapshot(observations(spark, site, two))
    spark.sql(f"drop table {store._snapshot_table()}")
    again = Store(spark, str(tmp_path), new_buckets=99)
    assert again.buckets == store.buckets
    again.write_snapshot(observations(spark, site, two[:1]))
    found = sorted((r["site"], r["run_ts"], r["item_id"], r["price"]) for r in again.snapshots().collect())
    assert found == sorted([(site, START, "x", 1), ("other", START, "x", 1), (site, START + day, "x", 2)])


def test_history_and_merge_need_no_shuffle_of_stored_data(spark, tmp_path):
    profile = KINDS["presence"]
    rows, errors = history(6)
    store = Store(spark, str(tmp_path))
    seen = observations(spark, profile.site, rows)
    log = run_log(spark, profile.site, errors)
    store.write_snapshot(seen)
    store.write_snapshot(seen)
    stored = replay(store.snapshots(), log, [profile])
    assert change_rows(stored) == change_rows(replay(seen, log, [profile]))
    for ts in errors:
        one = store.snapshot(profile.site, ts)
        assert one.count() == seen.filter(F.col("run_ts") == F.lit(ts)).count()

    plan = item_sequence(store.snapshots(), log)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning(site#" not in plan.split("Broadcast")[0]

    newest = max(errors)
    run = open_run(log, profile.site, newest)
    listing = listing_state(seen.filter(F.col("run_ts") < F.lit(newest)), [profile])
    store.write_version(listing, profile.site, START)
    old = store.listing(profile.site, START)
    merged = merge(old, store.snapshot(profile.site, newest), run, profile)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(item_id") == 1 and "Bucketed: true" in plan


def test_an_announced_run_without_a_snapshot_stops_the_commit(spark, tmp_path):
    profile = KINDS["presence"]
    rows, errors = history(4, n_runs=2)
    store = Store(spark, str(tmp_path))
    runs = sorted(errors)
    seen = observations(spark, profile.site, rows)
    store.write_snapshot(seen.filter(F.col("run_ts") == F.lit(runs[0])))
    arrivals = run_log(spark, profile.site, errors).select("site", "run_ts", "error", "page", "count")
    arrivals = arrivals.withColumn("count", F.lit(5).cast("bigint"))
    with pytest.raises(ValueError, match="no snapshot has landed"):
        commit_arrivals(arrivals, store, {profile.site: profile})
    assert store.run_log().count() == 1
    # Landed as empty, it may be committed.
    store.write_snapshot(seen.limit(0), [(profile.site, runs[1])])
    commit_arrivals(arrivals, store, {profile.site: profile})
    assert store.run_log().count() == 2


@pytest.mark.parametrize("site", ["shop:jp", "a/b=c'd", "plain"])
def test_odd_site_names_and_empty_landings(spark, tmp_path, site):
    store = Store(spark, str(tmp_path))
    one = observations(spark, site, [{"ts": START, "item": "x", "price": 1}])
    assert not store.landed(site, START)
    store.write_snapshot(one)
    assert store.landed(site, START) and store.snapshot(site, START).count() == 1
    assert store.snapshots().count() == 1
    store.write_snapshot(one.limit(0), [(site, START)])
    assert store.landed(site, START) and store.snapshot(site, START).count() == 0
    assert store.snapshots().count() == 0
    store.write_snapshot(one, [(site, START)])
    assert store.snapshot(site, START).count() == 1 and store.snapshots().count() == 1


def test_uncommitted_snapshots_are_no_state(spark):
    profile = KINDS["presence"]
    rows, errors = history(4, n_runs=3)
    seen, log = observations(spark, profile.site, rows), run_log(spark, profile.site, errors)
    newest = F.lit(max(errors))
    state = listing_state(seen, [profile], log.filter(F.col("run_ts") < newest))
    expected = listing_state(seen.filter(F.col("run_ts") < newest), [profile])
    assert sorted(map(repr, state.collect())) == sorted(map(repr, expected.collect()))


def test_buckets_do_not_grow_with_partitions(spark, tmp_path):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 500)
    try:
        assert Store(spark, str(tmp_path)).buckets == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
