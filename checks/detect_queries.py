"""De-duplication, one-run diff, merge: the newest clean run against all runs before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from shelfdiff import AUCTION, PRESENCE, PROFILES, STATUS, detect, listing_state, merge
from shelfdiff.operators import detect as d
from shelfdiff.profiles import Profile
from shelfdiff.session import scratch_path
from shelfdiff.sources.tables import Store

A, B, C = fx.A, fx.B, fx.C
SEEN = ("item_id", "title", "price")


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = fx.snapshots(spark, sf_dir, fx.SITES)
    return fx.plain(seen.select("site", "run_ts", "item_id", "title", "price", "end_ts"))


def snapshot_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed per (site, run) and landed again: the second write replaces the first."""
    store = Store(spark, scratch_path(spark, "store"))
    seen = fx.snapshots(spark, sf_dir, (A,), fine=True)
    store.write_snapshot(seen)
    store.write_snapshot(seen)
    back = store.snapshots()
    return fx.plain(back.select("site", "run_ts", *SEEN, "full_price", "bid_num", "onsale"))


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, snapshot, listing = fx.run_and_state(spark, sf_dir, PRESENCE)
    return d.first_seen(snapshot, listing).select(*SEEN)


def _known_where(profile: Profile, condition, snapshot_filter: str = "true"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run, snapshot, listing = fx.run_and_state(spark, sf_dir, profile)
        stored = condition(run)
        return d.known_where(snapshot.filter(snapshot_filter), listing, stored).select(*SEEN)

    return query


def _kind(profile: Profile, kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run, snapshot, listing = fx.run_and_state(spark, sf_dir, profile)
        found = detect(snapshot, listing, run, profile).filter(F.col("kind") == kind)
        return fx.plain(found.drop("site", "run_ts", "kind"))

    return query


def vanished(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, snapshot, listing = fx.run_and_state(spark, sf_dir, PRESENCE)
    return d.vanished(snapshot, listing, run).select(*SEEN)


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, snapshot, listing = fx.run_and_state(spark, sf_dir, PRESENCE)
    return d.already_known(snapshot, listing).select(*SEEN)


def _merge(profile: Profile):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run, snapshot, listing = fx.run_and_state(spark, sf_dir, profile)
        return fx.plain(merge(listing, snapshot, run, profile))

    return query


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = fx.snapshots(spark, sf_dir, fx.SITES, fine=True)
    return fx.plain(listing_state(seen, PROFILES.values()))


QUERIES = {
    "dedup_first": dedup_first,
    "snapshot_write": snapshot_write,
    "new_first_seen": first_seen,
    "a_reappeared": _known_where(PRESENCE, lambda r: F.col("update_ts") < F.lit(r.last)),
    "c_reappeared": _known_where(
        AUCTION, lambda r: F.col("update_ts") < F.lit(r.last) - F.expr("interval 1 day")
    ),
    "b_relisted": _known_where(STATUS, lambda r: F.col("onsale") == 0, "onsale = 1"),
    "b_sold_known": _known_where(STATUS, lambda r: F.col("onsale") == 1, "onsale = 0"),
    **{f"a_{k}": _kind(PRESENCE, k) for k in ("new", "discount", "sold")},
    **{f"b_{k}": _kind(STATUS, k) for k in ("new", "discount", "sold")},
    **{f"c_{k}": _kind(AUCTION, k) for k in ("new", "discount", "bid")},
    "vanished": vanished,
    "merge_matched": matched,
    "merge_unmatched": first_seen,
    "merge_a": _merge(PRESENCE),
    "merge_b": _merge(STATUS),
    "merge_c": _merge(AUCTION),
    "listing_state": state,
}

FINE = "with " + fx.views(fine=True) + "," + fx.RUN_SQL
_SNAP = "select item_id, title, price from snap"


def _state(site: str) -> str:
    return FINE + ", state as (" + fx.state_sql(site) + ") "


def _kind_sql(site: str, kind: str) -> str:
    """Join of the snapshot with the state, written out per kind."""
    text = "l" if (site, kind) in ((A, "discount"), (A, "sold")) else "s"
    pairs = "snap s left join state l using (item_id)"
    rule = {
        (A, "new"): "l.update_ts is null or l.update_ts < (select last_ts from last)",
        (A, "discount"): "l.price > s.price",
        (B, "new"): "s.onsale = 1 and (l.update_ts is null or l.onsale = 0)",
        (B, "discount"): "s.onsale = 1 and l.price > s.price",
        (B, "sold"): "s.onsale = 0 and (l.update_ts is null or l.onsale = 1)",
        (C, "new"): "l.update_ts is null or l.update_ts < (select last_ts from last) - interval 1 day",
        (C, "discount"): "(l.price > s.price or l.full_price > s.full_price) and l.bid_num = 0",
        (C, "bid"): "l.bid_num < s.bid_num",
    }
    if (site, kind) == (A, "sold"):
        return _state(site) + (
            "select item_id, title, item_url, image_url, price as old_price,"
            " cast(null as bigint) as new_price, full_price as old_full,"
            " cast(null as bigint) as new_full, bid_num as old_num, cast(null as int) as new_num, "
            + fx.time_text("end_ts")
            + " from state where update_ts >= (select last_ts from last)"
            " and item_id not in (select item_id from snap)"
        )
    return _state(site) + (
        f"select item_id, {text}.title as title, {text}.item_url as item_url,"
        f" {text}.image_url as image_url, l.price as old_price, s.price as new_price,"
        " l.full_price as old_full, s.full_price as new_full, l.bid_num as old_num,"
        f" s.bid_num as new_num, {fx.time_text('s.end_ts', 'end_ts')}"
        f" from {pairs} where {rule[site, kind]}"
    )


def _merge_sql(site: str) -> str:
    columns = []
    for c in fx.LISTING_COLUMNS:
        if c in ("site", "item_id"):
            value = f"'{site}'" if c == "site" else "item_id"
        elif c == "update_ts":
            value = "case when s.run_ts is not null then s.run_ts else l.update_ts end"
        elif c == "record_ts":
            value = "case when l.item_id is not null then l.record_ts else s.run_ts end"
        elif c in fx.UPDATED[site]:
            value = f"case when s.item_id is not null then s.{c} else l.{c} end"
        else:
            value = f"case when l.item_id is not null then l.{c} else s.{c} end"
        if c in ("end_ts", "record_ts", "update_ts"):
            value = f"strftime({value}, {fx.TIME})"
        columns.append(f"{value} as {c}")
    return _state(site) + (
        f"select {', '.join(columns)} from state l full join snap s using (item_id)"
    )


def _state_all() -> str:
    numbered = (
        ", every as (select *, row_number() over (partition by item_id order by run_ts) as up,"
        " row_number() over (partition by item_id order by run_ts desc) as down from obs)"
    )
    times = ", ".join(fx.time_text(c) for c in ("end_ts", "record_ts", "update_ts"))
    union = " union all ".join(fx.state_sql(s, "every") for s in fx.SITES)
    return (
        "with " + fx.views(fine=True) + numbered
        + f" select * exclude (end_ts, record_ts, update_ts), {times} from ({union})"
    )


def _per_site(sql: str) -> str:
    return " union all ".join(f"select '{s}' as site, {sql}" for s in fx.SITES)


def _semi(site: str, stored: str, filter_: str = "true") -> str:
    return _state(site) + (
        f"{_SNAP} where {filter_} and item_id in (select item_id from state where {stored})"
    )


_UNSEEN = _state(A) + _SNAP + " where item_id not in (select item_id from state)"

ORACLES = {
    "dedup_first": "with " + fx.views() + " " + _per_site(
        fx.time_text("run_ts") + ", item_id, title, price, " + fx.time_text("end_ts") + " from obs"
    ),
    "snapshot_write": fx.plain_sql(
        "with " + fx.views(fine=True) + f" select '{A}' as site, " + fx.time_text("run_ts")
        + ", item_id, title, price, full_price, bid_num, onsale from obs",
        *fx.ITEM_NUMBERS,
    ),
    "new_first_seen": _UNSEEN,
    "a_reappeared": _semi(A, "update_ts < (select last_ts from last)"),
    "c_reappeared": _semi(C, "update_ts < (select last_ts from last) - interval 1 day"),
    "b_relisted": _semi(B, "onsale = 0", "onsale = 1"),
    "b_sold_known": _semi(B, "onsale = 1", "onsale = 0"),
    **{f"a_{k}": fx.plain_sql(_kind_sql(A, k), *fx.MONEY) for k in ("new", "discount", "sold")},
    **{f"b_{k}": fx.plain_sql(_kind_sql(B, k), *fx.MONEY) for k in ("new", "discount", "sold")},
    **{f"c_{k}": fx.plain_sql(_kind_sql(C, k), *fx.MONEY) for k in ("new", "discount", "bid")},
    "vanished": _state(A) + "select item_id, title, price from state where update_ts >="
    " (select last_ts from last) and item_id not in (select item_id from snap)",
    "merge_matched": _semi(A, "true"),
    "merge_unmatched": _UNSEEN,
    "merge_a": fx.plain_sql(_merge_sql(A), *fx.ITEM_NUMBERS),
    "merge_b": fx.plain_sql(_merge_sql(B), *fx.ITEM_NUMBERS),
    "merge_c": fx.plain_sql(_merge_sql(C), *fx.ITEM_NUMBERS),
    "listing_state": fx.plain_sql(_state_all(), *fx.ITEM_NUMBERS),
}
