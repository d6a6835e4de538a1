"""Landed payloads to digest parts, all sites, previewed and committed."""

import json
from datetime import timedelta

import pytest
from data import START
from pyspark.sql import functions as F
from test_sources import ITEM, HTML, callback

from shelfdiff import AUCTION, PRESENCE, STATUS, remove_rule, run_all, run_site
from shelfdiff.schema import PAYLOAD, RULES
from shelfdiff.sources.tables import Store

DAY = timedelta(days=1)


def payload(spark, days):
    """days: list of {site: [(keyword, page, status, body)]}"""
    rows = [
        (site, START + DAY * n, *page)
        for n, day in enumerate(days)
        for site, pages in day.items()
        for page in pages
    ]
    return spark.createDataFrame(rows, PAYLOAD)


def m(item_id, price, status="on_sale"):
    return {
        "id": item_id,
        "seller": {"id": 1},
        "name": "n",
        "thumbnails": ["https://t/x.jpg"],
        "price": price,
        "status": status,
    }


DAYS = [
    {
        PRESENCE.site: [("k", 1, 200, callback([ITEM, {**ITEM, "itemid": 2}]))],
        STATUS.site: [("k", 1, 200, json.dumps({"data": [m("m1", 50), m("m2", 70)]}))],
        AUCTION.site: [("k", 1, 200, HTML)],
    },
    {
        PRESENCE.site: [("k", 1, 200, callback([{**ITEM, "price": 900}, {**ITEM, "itemid": 3}]))],
        STATUS.site: [
            ("k", 1, 200, json.dumps({"data": [m("m1", 40), m("m2", 70, "sold_out"), m("m3", 9)]}))
        ],
        AUCTION.site: [("k", 1, 200, HTML.replace('"1200"', '"1100"').replace("12<i>", "30<i>"))],
    },
]


def test_two_runs_of_all_sites(spark, tmp_path):
    df, store = payload(spark, DAYS), Store(spark, str(tmp_path))
    _, preview = run_all(df, store, START)
    assert all(r.changes.isEmpty() for r in preview.values()) and store.run_log().isEmpty()
    run_all(df, store, START, commit=True)
    parts, results = run_all(df, store, START + DAY, commit=True)

    found = {
        site: sorted((r["kind"], r["item_id"], r["old_price"], r["new_price"]) for r in result.changes.collect())
        for site, result in results.items()
    }
    assert found == {
        PRESENCE.site: [("discount", "1", 1200, 900), ("new", "3", None, 1200), ("sold", "2", 1200, None)],
        STATUS.site: [("discount", "m1", 50, 40), ("new", "m3", None, 9), ("sold", "m2", 70, 70)],
        # a stored bid hides the drop
        AUCTION.site: [("bid", "x1", 1200, 1100)],
    }
    log = {(r["site"], r["run_ts"]): r for r in store.run_log().collect()}
    assert len(log) == 6
    last = log[AUCTION.site, START + DAY]
    assert (last["error"], last["page"], last["count"], last["sold"]) == (0, 1, 2, 1)

    bodies = [r["body"] for r in sorted(parts.collect(), key=lambda r: (r["site_no"], r["part_no"]))]
    assert [b.split("<br>")[0] for b in bodies] == [
        "<b>Lashinbang Updater</b>",
        "<b>Mercari Updater</b>",
        "<b>Yahoo Updater</b>",
    ]
    assert "x1  A &" in bodies[2] and "12 -> 30 bid" in bodies[2]

    again = run_site(df, store, PRESENCE, START + DAY, commit=True)
    assert sorted(map(repr, again.changes.collect())) == sorted(map(repr, results[PRESENCE.site].changes.collect()))
    assert again.summary.first()["sold"] == 1 and store.run_log().count() == 6
    with pytest.raises(ValueError, match="not newer"):
        run_site(payload(spark, DAYS[:1]).withColumn("run_ts", F.col("run_ts") - F.expr("interval 1 day")), store, PRESENCE, START - DAY, commit=True)


def test_a_commit_that_failed_at_one_site_can_be_finished(spark, tmp_path):
    """A site without pages stops the commit before the first write; a failure later on
    leaves sites that the same call finishes."""
    store = Store(spark, str(tmp_path))
    lacking = payload(spark, [{k: v for k, v in DAYS[0].items() if k != STATUS.site}])
    with pytest.raises(ValueError, match="no page"):
        run_all(lacking, store, START, commit=True)
    assert store.run_log().isEmpty() and store.changes().isEmpty()
    df = payload(spark, DAYS)
    run_all(df, store, START, commit=True)
    run_site(df, store, PRESENCE, START + DAY, commit=True)
    parts, results = run_all(df, store, START + DAY, commit=True)
    assert store.run_log().count() == 6
    assert {s: r.changes.count() for s, r in results.items()} == {PRESENCE.site: 3, STATUS.site: 3, AUCTION.site: 1}
    stored = sorted(map(repr, store.changes().collect()))
    assert stored == sorted(repr(x) for r in results.values() for x in r.changes.collect())
    assert store.expire(PRESENCE.site, keep=1) == 1
    assert sorted(map(repr, store.changes().collect())) == stored


def test_a_faulty_run_reports_no_sold_items_and_does_not_move_the_clean_run(spark, tmp_path):
    broken = {PRESENCE.site: [("k", 1, 200, callback([{**ITEM, "itemid": 2}])), ("l", 1, 500, None)]}
    days = [{PRESENCE.site: DAYS[0][PRESENCE.site]}, broken, {PRESENCE.site: DAYS[1][PRESENCE.site]}]
    df, store = payload(spark, days), Store(spark, str(tmp_path))
    kinds = []
    for n in range(3):
        result = run_site(df, store, PRESENCE, START + DAY * n, commit=True)
        kinds.append(sorted((r["kind"], r["item_id"]) for r in result.changes.collect()))
    # item 2 was last seen in the faulty run, later than the clean one: sold now
    assert kinds == [[], [], [("discount", "1"), ("new", "3"), ("sold", "2")]]
    assert [r["reason"] for r in result.quarantine.collect()] == []


def test_a_run_without_pages_is_refused(spark, tmp_path):
    df, store = payload(spark, DAYS), Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no page"):
        run_site(df, store, PRESENCE, START + 7 * DAY, commit=True)
    assert store.run_log().isEmpty()


def test_rules_come_before_the_diff(spark, tmp_path):
    df, store = payload(spark, DAYS), Store(spark, str(tmp_path))
    store.save_rules(spark.createDataFrame([(1, STATUS.site, "price < 45"), (2, STATUS.site, "price < 0")], RULES))
    rules = store.save_rules(remove_rule(store.rules(), 2))
    assert [r["rule_id"] for r in rules.collect()] == [1]
    run_site(df, store, STATUS, START, rules, commit=True)
    result = run_site(df, store, STATUS, START + DAY, rules)
    assert [(r["kind"], r["item_id"]) for r in result.changes.collect()] == [("sold", "m2")]
    assert result.removed.first()["hits"] == 2
