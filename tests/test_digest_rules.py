from datetime import timedelta

import pytest
from checks.replay_queries import CUSTOM
from data import KINDS, START, history, observations, run_log

from pyspark.sql import functions as F

from shelfdiff import (
    add_rule,
    apply_rules,
    digest_lines,
    get_rules,
    remove_rule,
    replay,
    run_summary,
)
from shelfdiff.operators.digest import cut_lines
from shelfdiff.schema import CHANGES, RULES, RUN_LOG


def lines_of(spark, seed=3):
    seen, log = None, None
    for profile in KINDS.values():
        rows, errors = history(seed)
        own, own_log = observations(spark, profile.site, rows), run_log(spark, profile.site, errors)
        seen = own if seen is None else seen.unionByName(own)
        log = own_log if log is None else log.unionByName(own_log)
    changes = replay(seen, log, KINDS.values())
    return digest_lines(changes, run_summary(changes, log), KINDS.values())


@pytest.mark.parametrize("limit", [7, 100, 4096])
def test_parts_are_the_joined_lines_cut_by_length(spark, limit):
    lines = lines_of(spark)
    whole = {}
    for r in sorted(
        lines.collect(), key=lambda r: (r["site_no"], r["run_ts"], r["section"], r["entry"], r["item_id"])
    ):
        key = (r["site_no"], r["run_ts"])
        whole[key] = whole.get(key, "") + r["line"]
    parts = {}
    for r in sorted(cut_lines(lines, limit).collect(), key=lambda r: r["part_no"]):
        parts.setdefault((r["site_no"], r["run_ts"]), []).append(r["body"])
    assert parts == {
        key: [text[i : i + limit] for i in range(0, len(text), limit)] for key, text in whole.items()
    }


def one_change(spark, site, **values):
    row = {"site": site, "run_ts": START, "item_id": "x1", "title": "T", "item_url": "u", **values}
    return spark.createDataFrame([tuple(row.get(c) for c in CHANGES.names)], CHANGES)


def item_line(spark, rules, **values):
    profile = KINDS[rules]
    changes = one_change(spark, profile.site, **values)
    log = spark.createDataFrame([(profile.site, START, 1, 2, 3, 0, 0, 0)], RUN_LOG)
    lines = digest_lines(changes, run_summary(changes, log), [profile])
    return [r["line"] for r in lines.orderBy("section", "entry").collect()]


def test_line_formats(spark):
    lines = item_line(spark, "presence", kind="discount", old_price=300, new_price=200)
    assert lines == [
        "<b>Lashinbang Updater</b><br>Time: 2024-01-01 09:00:00+09:00<br>Entries: 3    Error: 1<br>",
        "<br><b>[NEW] ---------- 0</b><br>",
        "<br><b>[DISCOUNT] ---------- 1</b><br>",
        '<a href="u">x1  T</a><br>JPY 300 -> 200<br>',
        "<br><b>[SOLD] ---------- 0</b><br>",
    ]
    assert item_line(spark, "presence", kind="sold", old_price=300)[-1].endswith("JPY 300<br>")
    assert item_line(spark, "status", kind="sold", old_price=300, new_price=None)[-1].endswith("JPY None<br>")
    end = START + timedelta(hours=1)
    price = {"old_price": 9, "new_price": 7, "end_ts": end}
    tail = "<br>End 2024-01-01 10:00:00+09:00<br>"
    c = [
        item_line(spark, "auction", kind="new", new_full=0, new_num=2, **price)[2],
        item_line(spark, "auction", kind="discount", old_full=None, new_full=5, new_num=0, **price)[3],
        item_line(spark, "auction", kind="bid", old_full=8, new_full=8, old_num=1, new_num=3, **price)[4],
    ]
    assert [line.split("</a><br>")[1] for line in c] == [
        "JPY 7    2 bid" + tail,
        "JPY 9[None] -> 7[5]    0 bid" + tail,
        "JPY 7[8]    1 -> 3 bid" + tail,
    ]


def test_a_profile_of_ones_own_has_its_sections(spark):
    rows, errors = history(3)
    seen = observations(spark, CUSTOM.site, rows)
    log = run_log(spark, CUSTOM.site, errors)
    changes = replay(seen, log, [CUSTOM])
    summary = run_summary(changes, log)
    lines = digest_lines(changes, summary, [CUSTOM]).collect()
    found = {}
    for r in changes.collect():
        found[r["run_ts"], r["kind"]] = found.get((r["run_ts"], r["kind"]), 0) + 1
    assert {kind for _, kind in found} == set(CUSTOM.kinds)
    heads = {(r["run_ts"], r["section"]): r["line"] for r in lines if r["entry"] == 0}
    for ts in errors:
        for section, (kind, label) in enumerate(CUSTOM.sections.items(), start=1):
            assert heads[ts, section] == f"<br><b>[{label}] ---------- {found.get((ts, kind), 0)}</b><br>"
    assert sum(r["entry"] for r in lines) == sum(found.values())
    alerts = {r["run_ts"] for r in summary.filter("alert").collect()}
    assert alerts == {ts for ts, _ in found}


def test_title_line_breaks_become_spaces(spark):
    line = item_line(spark, "status", kind="new", new_price=1, title="a\nb")[2]
    assert line == '<a href="u">x1  a b</a><br>JPY 1<br>'


RULE_ROWS = [(1, "s", "price >= 20000"), (2, "s", "title = 'bad'"), (3, "other", "true")]


def test_rules(spark):
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    df = spark.createDataFrame(
        [("a", 20000), ("b", None), ("bad", 1), ("c", 5)], "title string, price bigint"
    )
    kept, hits = apply_rules(df, rules, "s")
    assert sorted(r["title"] for r in kept.collect()) == ["b", "c"]
    assert hits.collect()[0]["hits"] == 2
    untouched, none = apply_rules(df, rules, "nobody")
    assert untouched.count() == 4 and none.collect()[0]["hits"] == 0

    ids = lambda found: sorted(r["rule_id"] for r in found.collect())
    assert ids(get_rules(rules, rule_id=1, site="other", show_all=True)) == [1, 2, 3]
    assert ids(get_rules(rules, rule_id=1, site="other")) == [3]
    assert ids(get_rules(rules, rule_id=1)) == [1]
    assert ids(get_rules(rules)) == []
    assert ids(add_rule(rules, "s", "price = 1", df)) == [1, 2, 3, 4]
    assert ids(remove_rule(rules, 2)) == [1, 3]
    assert ids(add_rule(rules.filter("false"), "s", "price = 1", df)) == [1]


@pytest.mark.parametrize("bad", ["price >", "price + 1", "nothing = 1"])
def test_unusable_rules_are_refused(spark, bad):
    df = spark.createDataFrame([("a", 1)], "title string, price bigint")
    with pytest.raises(Exception):
        add_rule(spark.createDataFrame([], RULES), "s", bad, df)


def test_summary_keeps_quiet_runs(spark):
    profile = KINDS["status"]
    rows, errors = history(1)
    log = run_log(spark, profile.site, errors)
    found = run_summary(replay(observations(spark, profile.site, rows), log, [profile]), log)
    assert found.count() == len(errors)
    quiet = found.filter(F.col("new") + F.col("discount") + F.col("sold") == 0)
    assert quiet.count() and quiet.filter("alert").isEmpty()
