"""Whole runs of all sites, from landed pages to log and changes.

The history of all pages is committed up to the newest clean run, in one pass for each site;
that run then goes through `run_all`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.source_queries import event_pages
from shelfdiff import PRESENCE, run_all, run_site
from shelfdiff.functions.times import from_micros, micros
from shelfdiff.plans.run import run_history
from shelfdiff.session import scratch_path, settle
from shelfdiff.sources.tables import Store

SHOWN = ["site", "run_ts", "kind", "item_id", "old_price", "new_price"]


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for site in fx.SITES:
        own = event_pages(spark, sf_dir, site, errors=False)
        out = own if out is None else out.unionByName(own)
    return settle(out, "pages")


def _before_newest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Store, datetime]:
    """All pages, the store as the runs before the newest clean one left it, and that run."""
    pages = _pages(spark, sf_dir)
    clean = fx.runs(spark, sf_dir).filter("error = 0")
    newest = from_micros(clean.agg(micros(F.max("run_ts"))).first()[0])
    store = Store(spark, scratch_path(spark, "store"))
    run_history(pages.filter(F.col("run_ts") < F.lit(newest)), store)
    return pages, store, newest


def _shown(changes: DataFrame) -> DataFrame:
    return fx.plain(changes.select(*SHOWN))


def run_all_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the newest clean run would report; nothing is committed."""
    pages, store, newest = _before_newest(spark, sf_dir)
    _, results = run_all(pages, store, newest)
    out = None
    for result in results.values():
        out = result.changes if out is None else out.unionByName(result.changes)
    return _shown(out)


def _log(store: Store) -> DataFrame:
    return fx.plain(store.run_log().select("site", "run_ts", "error", "count", "new", "discount", "sold"))


def run_all_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after that run was committed too."""
    pages, store, newest = _before_newest(spark, sf_dir)
    run_all(pages, store, newest, commit=True)
    return _log(store)


def run_all_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes kept after a commit that one site had finished before."""
    pages, store, newest = _before_newest(spark, sf_dir)
    run_site(pages, store, PRESENCE, newest, commit=True)
    run_all(pages, store, newest, commit=True)
    return _shown(store.changes())


QUERIES = {
    "run_all_preview": run_all_preview,
    "run_all_commit": run_all_commit,
    "run_all_resumed": run_all_resumed,
}

# Pages of faulty days give no item; the first item of a run is that of the first keyword,
# and keywords are the event numbers as text.
_VIEWS = fx.views().replace("order by ts, event_id) as rn", "order by cast(event_id as varchar)) as rn").replace(
    "from obs_raw) where rn = 1)", "from obs_raw where extract(day from run_ts) % 5 <> 0) where rn = 1)"
)
_UPTO = "(select max(run_ts) from runs where error = 0)"
# Runs after the newest clean one do not count.
_CHANGES = f"select * from ({fx.CHANGE_SQL_ALL}) where run_ts <= {_UPTO}"
_SHOWN = f"site, {fx.time_text('run_ts')}, kind, item_id, old_price, new_price"
_PLAIN = ("old_price", "new_price")

ORACLES = {
    "run_all_preview": fx.plain_sql(
        f"with {_VIEWS} select {_SHOWN} from ({_CHANGES}) where run_ts = {_UPTO}", *_PLAIN
    ),
    "run_all_resumed": fx.plain_sql(f"with {_VIEWS} select {_SHOWN} from ({_CHANGES})", *_PLAIN),
    "run_all_commit": f"""with {_VIEWS}, found as (select site, run_ts, count(*) filter (where kind = 'new') as new,
        count(*) filter (where kind = 'discount') as discount,
        count(*) filter (where kind not in ('new', 'discount')) as sold from ({_CHANGES}) group by site, run_ts),
      every as (select unnest({list(fx.SITES)}) as site, run_ts, error, count from runs where run_ts <= {_UPTO})
      select e.site, {fx.time_text('e.run_ts', 'run_ts')}, case when error = 0 then 0 else count end as error,
        case when error = 0 then count else 0 end as count, coalesce(new, 0) as new,
        coalesce(discount, 0) as discount, coalesce(sold, 0) as sold
      from every e left join found f on e.site = f.site and e.run_ts = f.run_ts""",
}
