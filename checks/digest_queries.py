"""The digest of the whole change feed, line by line and in message parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from shelfdiff import PROFILES, digest, digest_lines, replay, run_summary
from shelfdiff.functions.text import PART_LIMIT
from shelfdiff.session import settle

A, B, C = fx.A, fx.B, fx.C


def _reported(spark: SparkSession, sf_dir: str, sites, fine: bool = False):
    """(changes, summary, profiles) of all runs."""
    profiles = [PROFILES[s] for s in sites]
    log = fx.runs(spark, sf_dir, sites)
    found = replay(fx.snapshots(spark, sf_dir, sites, fine), log, profiles)
    # read twice below, for the counts and for the lines
    changes = settle(found, "changes")
    return changes, run_summary(changes, log), profiles


def _lines(spark: SparkSession, sf_dir: str, sites, fine: bool = False) -> DataFrame:
    return digest_lines(*_reported(spark, sf_dir, sites, fine))


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, fx.SITES).filter(F.col("entry") == 0)
    return fx.plain(lines.select("site", "run_ts", "section", "line"))


def lines_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, (A, B)).filter(F.col("entry") == 1)
    return fx.plain(lines.select("site", "run_ts", "section", "item_id", "line"))


def lines_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, (C,), fine=True).filter(F.col("entry") == 1)
    return fx.plain(lines.select("site", "run_ts", "section", "item_id", "line"))


def parts(spark: SparkSession, sf_dir: str, sites) -> DataFrame:
    cut = digest(*_reported(spark, sf_dir, sites))
    return fx.plain(cut.select("site_no", "site", "run_ts", "part_no", "body"))


QUERIES = {
    "digest_header": header,
    "digest_lines": lines_ab,
    "digest_lines_c": lines_c,
    "digest": lambda spark, sf_dir: parts(spark, sf_dir, (A,)).drop("site_no"),
    "digest_parts": lambda spark, sf_dir: parts(spark, sf_dir, fx.SITES),
}

_LOCAL = "strftime({} + interval 9 hour, '%Y-%m-%d %H:%M:%S') || '+09:00'"
_HEADINGS = {A: "Lashinbang Updater", B: "Mercari Updater", C: "Yahoo Updater"}
_THIRD = {A: ("sold", "SOLD"), B: ("sold", "SOLD"), C: ("bid", "BID")}
_LINK = "'<a href=\"' || item_url || '\">' || item_id || '  ' || title || '</a><br>' || "


def _headers() -> str:
    out = []
    for no, (site, heading) in enumerate(_HEADINGS.items()):
        out.append(
            f"select {no} as site_no, '{site}' as site, r.run_ts, 0 as section, 0 as entry, '' as item_id,"
            f" '<b>{heading}</b><br>Time: ' || {_LOCAL.format('r.run_ts')} || '<br>Entries: ' || r.count"
            " || '    Error: ' || r.error || '<br>' as line from runs r"
        )
        kinds = (("new", "NEW"), ("discount", "DISCOUNT"), _THIRD[site])
        for section, (kind, label) in enumerate(kinds, start=1):
            out.append(
                f"select {no}, '{site}', r.run_ts, {section}, 0, '',"
                f" '<br><b>[{label}] ---------- ' || (select count(*) from changes c where c.site = '{site}'"
                f" and c.run_ts = r.run_ts and c.kind = '{kind}') || '</b><br>' from runs r"
            )
    return " union all ".join(out)


_NONE = "coalesce(cast({} as varchar), 'None')"


def _money(bid: str, full: str) -> str:
    return (
        _NONE.format(bid)
        + f" || case when new_full > 0 then '[' || {_NONE.format(full)} || ']' else '' end"
    )


def _items() -> str:
    new, old = _NONE.format("new_price"), _NONE.format("old_price")
    tail = f" || '    ' || {{}} || ' bid<br>End ' || {_LOCAL.format('end_ts')} || '<br>'"
    num = _NONE.format("new_num")
    body = {
        (A, "new"): f"'JPY ' || {new} || '<br>'",
        (A, "discount"): f"'JPY ' || {old} || ' -> ' || {new} || '<br>'",
        (A, "sold"): f"'JPY ' || {old} || '<br>'",
        (B, "new"): f"'JPY ' || {new} || '<br>'",
        (B, "discount"): f"'JPY ' || {old} || ' -> ' || {new} || '<br>'",
        (B, "sold"): f"'JPY ' || {new} || '<br>'",
        (C, "new"): f"'JPY ' || {_money('new_price', 'new_full')}" + tail.format(num),
        (C, "discount"): f"'JPY ' || {_money('old_price', 'old_full')} || ' -> ' || "
        + _money("new_price", "new_full") + tail.format(num),
        (C, "bid"): f"'JPY ' || {_money('new_price', 'new_full')}"
        + tail.format(f"{_NONE.format('old_num')} || ' -> ' || {num}"),
    }
    order = {"new": 1, "discount": 2, "sold": 3, "bid": 3}
    out = []
    for (site, kind), line in body.items():
        no = fx.SITES.index(site)
        out.append(
            f"select {no} as site_no, site, run_ts, {order[kind]} as section, 1 as entry, item_id,"
            f" {_LINK}{line} as line from changes where site = '{site}' and kind = '{kind}'"
        )
    return " union all ".join(out)


def _with(fine: bool = False) -> str:
    return (
        "with " + fx.views(fine) + ", changes as (" + fx.CHANGE_SQL_ALL + "), headers as ("
        + _headers() + "), items as (" + _items() + ")"
    )


_PARTS = f""", whole as (
  select site_no, site, run_ts, string_agg(line, '' order by section, entry, item_id) as body
  from (select * from headers union all select * from items) group by all),
parts as (
  select site_no, site, run_ts, body,
         unnest(generate_series(0, (length(body) - 1) // {PART_LIMIT})) as part_no from whole)
select site_no, site, {fx.time_text('run_ts')}, part_no,
       substr(body, part_no * {PART_LIMIT} + 1, {PART_LIMIT}) as body from parts"""
_LINE = "site, " + fx.time_text("run_ts") + ", section, "

ORACLES = {
    "digest_header": _with() + f" select {_LINE} line from headers",
    "digest_lines": _with() + f" select {_LINE} item_id, line from items where site_no < 2",
    "digest_lines_c": _with(fine=True) + f" select {_LINE} item_id, line from items where site_no = 2",
    "digest": f"select * exclude (site_no) from ({_with()}{_PARTS}) where site_no = 0",
    "digest_parts": _with() + _PARTS,
}
