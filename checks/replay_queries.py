"""The change feed of all runs, the run log around it, and a site of one's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from shelfdiff import PROFILES, Profile, replay, run_summary, with_stable
from shelfdiff import last_stable as last_stable_of
from shelfdiff.operators.replay import item_sequence
from shelfdiff.schema import RUN_LOG
from shelfdiff.session import scratch_path
from shelfdiff.sources.tables import Store

A, B, C = fx.A, fx.B, fx.C


def changes(spark: SparkSession, sf_dir: str, sites=fx.SITES, fine: bool = False) -> DataFrame:
    seen = fx.snapshots(spark, sf_dir, sites, fine)
    log = fx.runs(spark, sf_dir, sites)
    return replay(seen, log, [PROFILES[s] for s in sites])


def _changes(*sites: str, fine: bool = False):
    return lambda spark, sf_dir: fx.plain(changes(spark, sf_dir, sites, fine))


def changes_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay over landed snapshots: bucketed by item, so nothing is shuffled again."""
    store = Store(spark, scratch_path(spark, "store"))
    store.write_snapshot(fx.snapshots(spark, sf_dir, fx.SITES, fine=True))
    log = fx.runs(spark, sf_dir, fx.SITES)
    return fx.plain(replay(store.snapshots(), log, PROFILES.values()))


def stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = with_stable(fx.runs(spark, sf_dir, fx.SITES))
    return fx.plain(log.select("site", "run_ts", "error", "last_stable"))


def next_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = with_stable(fx.runs(spark, sf_dir, fx.SITES))
    return fx.plain(log.select("site", "run_ts", "error", "next_stable"))


def last_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(last_stable_of(fx.runs(spark, sf_dir, fx.SITES)))


def seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = item_sequence(fx.snapshots(spark, sf_dir), fx.runs(spark, sf_dir))
    return fx.plain(
        rows.select(
            "run_ts", "item_id", "price", "p_ts", "n_ts", "p_price", "p_onsale", "p_bid_num", "first_title"
        )
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.runs(spark, sf_dir, fx.SITES)
    found = replay(fx.snapshots(spark, sf_dir, fx.SITES), log, PROFILES.values())
    return run_summary(found, log)


def run_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(summary(spark, sf_dir).drop("alert"))


def alert_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(summary(spark, sf_dir).select("site", "run_ts", "alert"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to a log table site by site, then read back whole."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = summary(spark, sf_dir)
    for site in fx.SITES:
        store.append_log(rows.filter(F.col("site") == site))
    return fx.plain(store.run_log().select(*RUN_LOG.names))


# A fourth kind of site, as a user would add it: prices that went up by a tenth or more,
# bids that were withdrawn, and items missing from a clean run.
CUSTOM = Profile(
    site="custom",
    heading="Custom Updater",
    changes={
        "raised": "price * 10 >= p_price * 11",
        "withdrawn": "bid_num < p_bid_num",
    },
    update_cols=("price", "bid_num"),
    gone_kind="missing",
    sections={"raised": "RAISED", "withdrawn": "WITHDRAWN", "missing": "MISSING"},
)


def custom_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = fx.snapshots(spark, sf_dir, (CUSTOM.site,), fine=True)
    log = fx.runs(spark, sf_dir, (CUSTOM.site,))
    return fx.plain(replay(seen, log, [CUSTOM]))


QUERIES = {
    "changes_a": _changes(A),
    "changes_b": _changes(B),
    "changes_c": _changes(C),
    "changes_c_fine": _changes(C, fine=True),
    "changes_all": _changes(*fx.SITES),
    "changes_landed": changes_landed,
    "last_stable": stable,
    "last_clean_run": last_clean,
    "next_stable": next_stable,
    "seq": seq,
    "run_summary": run_summary_text,
    "alert_flag": alert_flag,
    "run_log": run_log,
    "custom_profile": custom_profile,
}

_COARSE = "with " + fx.views() + " "
_CHANGES = ", changes as (" + fx.CHANGE_SQL_ALL + ") "


def _changes_sql(union: str, fine: bool = False) -> str:
    query = "with " + fx.views(fine) + f" select {fx.CHANGE_COLUMNS} from ({union})"
    return fx.plain_sql(query, *fx.MONEY)


def _runs_per_site(columns: str) -> str:
    return _COARSE + " union all ".join(f"select '{s}' as site, {columns}" for s in fx.SITES)


SUMMARY = (
    "with " + fx.views() + _CHANGES
    + ", sites as (" + " union all ".join(f"select '{s}' as site" for s in fx.SITES) + ")"
    + ", summary as (select s.site, r.run_ts, r.error, r.page, r.count,"
    " count(*) filter (where kind = 'new') as new,"
    " count(*) filter (where kind = 'discount') as discount,"
    " count(*) filter (where kind in ('sold', 'bid')) as sold"
    " from runs r join sites s on true left join changes c on c.site = s.site and c.run_ts = r.run_ts"
    " group by all) "
)
_LOG = (
    SUMMARY + "select site, " + fx.time_text("run_ts")
    + ", error, page, count, new, discount, sold from summary"
)
_CUSTOM_SQL = " union all ".join(
    [
        fx.branch("custom", "raised", "last_stable is not null and price * 10 >= p_price * 11"),
        fx.branch("custom", "withdrawn", "last_stable is not null and bid_num < p_num"),
        fx.branch(
            "custom",
            "missing",
            "next_stable is not null and (n_ts is null or n_ts > next_stable)"
            " and (error = 0 or last_stable is not null)",
            "next_stable as run_ts, item_id, title, item_url, image_url",
            fx.GONE,
        ),
    ]
)

ORACLES = {
    "changes_a": _changes_sql(fx.CHANGE_SQL[A]),
    "changes_b": _changes_sql(fx.CHANGE_SQL[B]),
    "changes_c": _changes_sql(fx.CHANGE_SQL[C]),
    "changes_c_fine": _changes_sql(fx.CHANGE_SQL[C], fine=True),
    "changes_all": _changes_sql(fx.CHANGE_SQL_ALL),
    "changes_landed": _changes_sql(fx.CHANGE_SQL_ALL, fine=True),
    "last_stable": _runs_per_site(
        fx.time_text("run_ts") + ", error, " + fx.time_text("last_stable") + " from rl"
    ),
    "last_clean_run": _runs_per_site(
        fx.time_text("max(run_ts)", "last_ts") + " from runs where error = 0"
    ),
    "next_stable": _runs_per_site(
        fx.time_text("run_ts") + ", error, " + fx.time_text("next_stable") + " from rl"
    ),
    "seq": fx.plain_sql(
        _COARSE + "select " + fx.time_text("run_ts") + ", item_id, price, "
        + fx.time_text("p_ts") + ", " + fx.time_text("n_ts")
        + ", p_price, p_onsale, p_num as p_bid_num, first_title from seq",
        "p_price", "p_onsale", "p_bid_num",
    ),
    "run_summary": _LOG,
    "alert_flag": SUMMARY + "select site, " + fx.time_text("run_ts")
    + ", new + discount + sold > 0 as alert from summary",
    "run_log": _LOG,
    "custom_profile": _changes_sql(_CUSTOM_SQL, fine=True),
}
