import pytest
from data import KINDS, change_rows, history, observations, run_log
from model import play

from pyspark.sql import functions as F

from shelfdiff import listing_state, replay
from shelfdiff.operators.runlog import attach_runs, run_bounds, with_stable


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("seed", range(4))
def test_replay_equals_the_sequential_model(spark, kind, seed):
    profile = KINDS[kind]
    rows, errors = history(seed)
    expected, state = play(kind, rows, errors)
    seen = observations(spark, profile.site, rows)
    log = run_log(spark, profile.site, errors)
    assert change_rows(replay(seen, log, [profile])) == sorted(expected, key=repr)

    stored = {r["item_id"]: r for r in listing_state(seen, [profile]).collect()}
    assert set(stored) == set(state)
    for item, old in state.items():
        row = stored[item]
        assert (row["price"], row["title"], row["onsale"], row["full_price"], row["bid_num"]) == (
            old["price"],
            old["title"],
            old["onsale"],
            old["full"],
            old["num"],
        )
        assert (row["record_ts"], row["update_ts"]) == (old["record"], old["update"])


@pytest.mark.parametrize("kind", KINDS)
def test_sliced_windows_give_the_same(spark, kind):
    profile = KINDS[kind]
    rows, errors = history(11, n_runs=23)
    seen = observations(spark, profile.site, rows)
    log = run_log(spark, profile.site, errors)
    whole = replay(seen, log, [profile])
    for slice_runs in (1, 2, 5):
        sliced = replay(seen, log, [profile], item_rows=slice_runs)
        assert sorted(map(repr, sliced.collect())) == sorted(map(repr, whole.collect()))


def test_shuffled_run_join_gives_the_same(spark):
    profile = KINDS["presence"]
    rows, errors = history(5)
    seen = observations(spark, profile.site, rows)
    log = run_log(spark, profile.site, errors)
    newest = max(r["ts"] for r in rows)
    log = log.withColumn("count", F.when(F.col("run_ts") == F.lit(newest), 100).otherwise(5))
    stable = with_stable(log).select("site", "run_ts", "count", "error", "last_stable", "next_stable")
    bounds = run_bounds(log)
    small = attach_runs(seen, stable, bounds)
    columns = ["site", "run_ts", "item_id", "last_stable", "next_stable"]
    expected = sorted(map(repr, small.select(columns).collect()))
    # no hot run, one hot run, all runs hot
    for hot_runs in (0, 3, 1000):
        shuffled = attach_runs(seen, stable, bounds, broadcast_rows=0, hot_runs=hot_runs)
        assert set(shuffled.columns) == set(small.columns)
        assert sorted(map(repr, shuffled.select(columns).collect())) == expected


def test_day_by_day_log_gives_the_same(spark):
    errors = history(8, n_runs=40, hours=5)[1]
    log = run_log(spark, "s", errors).unionByName(run_log(spark, "t", history(9, n_runs=31)[1]))
    expected = with_stable(log)
    by_day = with_stable(log, widest=40, site_runs=10)
    columns = ["site", "run_ts", "last_stable", "next_stable", "run_no"]
    assert sorted(map(repr, by_day.select(columns).collect())) == sorted(
        map(repr, expected.select(columns).collect())
    )


def test_sites_do_not_mix(spark):
    rows, errors = history(2)
    seen, log, expected = None, None, []
    for kind, profile in KINDS.items():
        own, own_log = observations(spark, profile.site, rows), run_log(spark, profile.site, errors)
        seen = own if seen is None else seen.unionByName(own)
        log = own_log if log is None else log.unionByName(own_log)
        expected += [(profile.site, *c) for c in play(kind, rows, errors)[0]]
    found = replay(seen, log, KINDS.values()).collect()
    got = [
        (r["site"], r["run_ts"], r["kind"], r["item_id"], r["old_price"], r["new_price"])
        for r in found
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_stored_title_is_reported_where_the_rule_says_so(spark):
    """Presence discounts show the stored title, status discounts the new one."""
    rows, errors = history(3)
    for kind in ("presence", "status"):
        profile = KINDS[kind]
        seen = observations(spark, profile.site, rows)
        log = run_log(spark, profile.site, errors)
        titles = {(r["ts"], r["item"]): r["title"] for r in rows}
        first = {}
        for r in sorted(rows, key=lambda r: r["ts"]):
            first.setdefault(r["item"], r["title"])
        found = replay(seen, log, [profile]).filter(F.col("kind") == "discount").collect()
        assert found
        for r in found:
            now = titles[r["run_ts"], r["item_id"]]
            assert r["title"] == (first[r["item_id"]] if kind == "presence" else now)


def test_a_site_with_only_faulty_runs_reports_nothing(spark):
    for profile in KINDS.values():
        rows, errors = history(7)
        errors = dict.fromkeys(errors, 1)
        seen = observations(spark, profile.site, rows)
        assert replay(seen, run_log(spark, profile.site, errors), [profile]).isEmpty()
