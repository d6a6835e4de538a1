"""Item streams: batches in any split, late rows, repeats and folds give what a history gives."""

from datetime import timedelta

import pytest
from data import KINDS, START, change_rows, history, observations, run_log

from pyspark.sql import functions as F

from shelfdiff import replay, with_stable
from shelfdiff.sources import layered as rows_of
from shelfdiff.streaming.items import SIGHTING, ItemStates


def sightings(spark, profile, rows, errors):
    log = with_stable(run_log(spark, profile.site, errors)).select("site", "run_ts", "last_stable")
    return observations(spark, profile.site, rows).join(log, ["site", "run_ts"]).select(*SIGHTING.names)


@pytest.mark.parametrize("kind", ["status", "auction"])
def test_batches_equal_the_history(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(rows_of, "FOLD", 2)
    profile = KINDS[kind]
    rows, errors = history(21, n_runs=9)
    seen = sightings(spark, profile, rows, errors).cache()
    expected = replay(observations(spark, profile.site, rows), run_log(spark, profile.site, errors), [profile])
    states = ItemStates(spark, str(tmp_path), buckets=2)
    runs = sorted(errors)
    for n, (lo, hi) in enumerate([(0, 3), (3, 4), (4, 8), (8, 9)]):
        part = seen.filter(F.col("run_ts").between(F.lit(runs[lo]), F.lit(runs[hi - 1])))
        states.take(part, [profile], f"s.{n}")
        if n == 2:
            states.take(part, [profile], f"s.{n}")  # repeated after a failure
    assert change_rows(states.changes()) == change_rows(expected)
    kinds = {x.kind for x in states.states(profile.site).all()}
    assert "base" in kinds or "fold" in kinds
    seen.unpersist()


def test_late_sightings_are_left_out_and_old_items_are_known(spark, tmp_path):
    profile = KINDS["status"]
    states = ItemStates(spark, str(tmp_path), buckets=2)
    years = timedelta(days=3000)
    errors = {START: 0, START + timedelta(days=1): 0, START + years: 0}

    def take(mark, *found):
        rows = [{"ts": ts, "item": item, "price": price, "onsale": 1} for ts, item, price in found]
        states.take(sightings(spark, profile, rows, errors), [profile], mark)

    take("s.0", (START + timedelta(days=1), "x", 100))
    take("s.1", (START, "x", 1), (START + timedelta(days=1), "x", 2))  # late, and once more
    take("s.2", (START + years, "x", 90))
    take("s.3")
    assert [(r["kind"], r["old_price"], r["new_price"]) for r in states.changes().orderBy("run_ts").collect()] == [
        ("new", None, 100),
        ("discount", 100, 90),
    ]
