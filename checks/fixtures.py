"""Inputs that Spark derives from the given tables.

`events` serves as the observations of 30 daily runs. Two item grains are used:

    coarse   item = user: seen in most runs, no buy-now price
    fine     item = user and k of the props: mostly new or reappearing, with a buy-now price

Days divisible by 5 count as faulty runs, so that the clean-run rules matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff import AUCTION, PRESENCE, STATUS, dedup_first, listing_state, open_run
from shelfdiff.operators.detect import Run
from shelfdiff.profiles import Profile
from shelfdiff.schema import LISTING, OBSERVATION, RUN_LOG
from shelfdiff.session import use_utc

A, B, C = PRESENCE.site, STATUS.site, AUCTION.site
SITES = (A, B, C)
ARRIVED = ("ts", "event_id")
EXTRA = ("ts", "event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str = "run_ts") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.withColumns({"ts": ts, "run_ts": F.date_trunc("day", ts)})


def raw_observations(
    spark: SparkSession, sf_dir: str, sites: Sequence[str] = (A,), fine: bool = False
) -> DataFrame:
    """One row per event and site, duplicates within a run included."""
    e = events(spark, sf_dir)
    if len(sites) > 1:
        # A file with few row groups would keep few cores busy with the rows of all sites.
        e = e.repartition("event_id")
    item = F.col("user_id").cast("string")
    full = F.lit(None)
    if fine:
        item = F.concat(item, F.lit("-"), F.get_json_object("props", "$.k"))
        full = F.minute("ts") * 100
    e = e.withColumn("item_id", item)
    known = {
        "site": F.explode(F.array(*[F.lit(s) for s in sites])),
        "keyword": F.col("event_type"),
        "page": F.lit(1),
        "pos": F.lit(0),
        "seller_id": F.col("event_type"),
        "title": F.concat_ws(" ", "event_type", "event_id"),
        "item_url": F.concat(F.lit("https://shop.example/i/"), F.col("item_id")),
        "image_url": F.concat(F.lit("https://img.example/"), F.col("event_id"), F.lit(".jpg")),
        "price": F.round(F.col("value") * 100),
        "full_price": full,
        "bid_num": F.when(F.col("event_type") == "view", 0).otherwise(F.floor(F.col("value") / 10)),
        "onsale": F.when(F.col("event_type") != "purchase", 1).otherwise(0),
        "end_ts": F.col("ts") + F.expr("interval 36 hours"),
    }
    columns = []
    for f in OBSERVATION:
        value = known.get(f.name, F.col(f.name))
        columns.append(value.alias(f.name) if f.name == "site" else value.cast(f.dataType).alias(f.name))
    return e.select(*columns, *EXTRA)


def snapshots(
    spark: SparkSession, sf_dir: str, sites: Sequence[str] = (A,), fine: bool = False
) -> DataFrame:
    return dedup_first(raw_observations(spark, sf_dir, sites, fine), ARRIVED).drop(*EXTRA)


def runs(spark: SparkSession, sf_dir: str, sites: Sequence[str] = (A,)) -> DataFrame:
    """The run log's page, item and error counts; no changes counted yet."""
    per_day = (
        events(spark, sf_dir)
        .groupBy("run_ts")
        .agg(F.count("*").alias("count"), F.count_distinct("event_type").alias("page"))
        .withColumn("error", F.when(F.day("run_ts") % 5 == 0, 1).otherwise(0))
    )
    log = per_day.withColumn("site", F.explode(F.array(*[F.lit(s) for s in sites])))
    for c in ("new", "discount", "sold"):
        log = log.withColumn(c, F.lit(0))
    return log.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG])


def newest_clean_run(spark: SparkSession, sf_dir: str, site: str) -> Run:
    """The newest run without errors, judged against everything before it."""
    log = runs(spark, sf_dir, (site,))
    newest = log.filter("error = 0").agg(F.max("run_ts")).first()[0]
    return open_run(log, site, newest)


def run_and_state(
    spark: SparkSession, sf_dir: str, profile: Profile
) -> tuple[Run, DataFrame, DataFrame]:
    """(run, snapshot, listing): the newest clean run and the state all earlier runs left."""
    run = newest_clean_run(spark, sf_dir, profile.site)
    seen = snapshots(spark, sf_dir, (profile.site,), fine=True)
    snapshot = seen.filter(F.col("run_ts") == F.lit(run.run_ts))
    earlier = seen.filter(F.col("run_ts") < F.lit(run.run_ts))
    return run, snapshot, listing_state(earlier, [profile])


# Numbers that may be NULL are compared as text: engines differ in how they hand NULL
# integers to a data frame.
NULLABLE = frozenset(
    "old_price new_price old_full new_full old_num new_num full_price onsale bid_num"
    " p_price p_onsale p_bid_num price_read bids_read pos last_page".split()
)


def plain(df: DataFrame) -> DataFrame:
    """Times and nullable numbers as text, so that both engines compare the same values."""
    out = []
    for f in df.schema:
        if f.dataType.typeName() == "timestamp":
            out.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        elif f.name in NULLABLE:
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


LISTING_COLUMNS = LISTING.names

# The same inputs as SQL.


def views(fine: bool = False) -> str:
    item = "cast(user_id as varchar)"
    full = "cast(null as bigint)"
    if fine:
        item += " || '-' || json_extract_string(props, '$.k')"
        full = "cast(extract(minute from ts) * 100 as bigint)"
    return f"""
obs_raw as (
  select date_trunc('day', ts)::timestamp as run_ts, {item} as item_id, event_type, event_id, ts,
         event_type as seller_id, event_type || ' ' || event_id as title,
         'https://shop.example/i/' || {item} as item_url,
         'https://img.example/' || event_id || '.jpg' as image_url,
         cast(round(value * 100) as bigint) as price, {full} as full_price,
         cast(case when event_type = 'view' then 0 else floor(value / 10) end as int) as bid_num,
         case when event_type <> 'purchase' then 1 else 0 end as onsale,
         ts + interval 36 hour as end_ts
  from events),
obs as (
  select * from (select *, row_number() over (partition by run_ts, item_id order by ts, event_id) as rn
                 from obs_raw) where rn = 1),
runs as (
  select run_ts, count(*) as count, count(distinct event_type) as page,
         cast(extract(day from run_ts) % 5 = 0 as bigint) as error
  from obs_raw group by run_ts),
rl as (
  select *, max(case when error = 0 then run_ts end) over (order by run_ts
              rows between unbounded preceding and 1 preceding) as last_stable,
            min(case when error = 0 then run_ts end) over (order by run_ts
              rows between 1 following and unbounded following) as next_stable
  from runs),
seq as (
  select o.*, error, last_stable, next_stable,
         lag(o.run_ts) over w as p_ts, lead(o.run_ts) over w as n_ts,
         lag(price) over w as p_price, lag(full_price) over w as p_full,
         lag(bid_num) over w as p_num, lag(onsale) over w as p_onsale,
         first_value(title) over w as first_title,
         first_value(item_url) over w as first_item_url,
         first_value(image_url) over w as first_image_url
  from obs o join rl using (run_ts)
  window w as (partition by item_id order by run_ts))"""


_NOW = "run_ts, item_id, title, item_url, image_url"
_FIRST = "item_id, first_title as title, first_item_url as item_url, first_image_url as image_url"
_BOTH = """p_price as old_price, price as new_price, p_full as old_full, full_price as new_full,
       p_num as old_num, bid_num as new_num, end_ts"""
GONE = """price as old_price, cast(null as bigint) as new_price, full_price as old_full,
       cast(null as bigint) as new_full, bid_num as old_num, cast(null as int) as new_num, end_ts"""


def branch(site: str, kind: str, where: str, head: str = _NOW, tail: str = _BOTH) -> str:
    return f"select '{site}' as site, '{kind}' as kind, {head}, {tail} from seq where {where}"


_JUDGED = "last_stable is not null and "

CHANGE_SQL = {
    A: " union all ".join(
        [
            branch(A, "new", _JUDGED + "(p_ts is null or p_ts < last_stable)"),
            branch(A, "discount", _JUDGED + "p_price > price", "run_ts, " + _FIRST),
            branch(
                A,
                "sold",
                "next_stable is not null and (n_ts is null or n_ts > next_stable)"
                " and (error = 0 or last_stable is not null)",
                "next_stable as run_ts, " + _FIRST,
                GONE,
            ),
        ]
    ),
    B: " union all ".join(
        [
            branch(B, "new", _JUDGED + "onsale = 1 and (p_ts is null or p_onsale = 0)"),
            branch(B, "discount", _JUDGED + "onsale = 1 and p_price > price"),
            branch(B, "sold", _JUDGED + "onsale = 0 and (p_ts is null or p_onsale = 1)"),
        ]
    ),
    C: " union all ".join(
        [
            branch(C, "new", _JUDGED + "(p_ts is null or p_ts < last_stable - interval 1 day)"),
            branch(C, "discount", _JUDGED + "(p_price > price or p_full > full_price) and p_num = 0"),
            branch(C, "bid", _JUDGED + "p_num < bid_num"),
        ]
    ),
}
CHANGE_SQL_ALL = " union all ".join(CHANGE_SQL.values())

TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def time_text(column: str, name: str | None = None) -> str:
    return f"strftime({column}, {TIME}) as {name or column}"


def plain_sql(query: str, *names: str) -> str:
    """`plain` for a SQL query whose times are text already; `names` are its nullable numbers."""
    casts = ", ".join(f"cast({n} as varchar) as {n}" for n in names)
    return f"select * replace ({casts}) from ({query})"


MONEY = ("old_price", "new_price", "old_full", "new_full", "old_num", "new_num")
ITEM_NUMBERS = ("full_price", "onsale", "bid_num")

CHANGE_COLUMNS = (
    "site, "
    + time_text("run_ts")
    + ", kind, item_id, title, item_url, image_url, old_price, new_price, old_full, new_full,"
    + " old_num, new_num, "
    + time_text("end_ts")
)

# The newest clean run, its snapshot and the state before it, per update profile.
RUN_SQL = """
run as (select max(run_ts) as run_ts from runs where error = 0),
last as (select max(run_ts) as last_ts from runs
         where error = 0 and run_ts < (select run_ts from run)),
snap as (select * from obs where run_ts = (select run_ts from run)),
before as (select *, row_number() over (partition by item_id order by run_ts) as up,
                  row_number() over (partition by item_id order by run_ts desc) as down
           from obs where run_ts < (select run_ts from run))"""

UPDATED = {
    A: ("price",),
    B: ("price", "onsale"),
    C: ("price", "full_price", "end_ts", "bid_num"),
}


def state_sql(site: str, rows: str = "before") -> str:
    """The listing that `rows` (numbered up and down per item) leaves."""
    columns = []
    for c in LISTING_COLUMNS[2:-2]:
        side = "z" if c in UPDATED[site] else "a"
        columns.append(f"{side}.{c} as {c}")
    return (
        f"select '{site}' as site, a.item_id, {', '.join(columns)}, a.run_ts as record_ts,"
        f" z.run_ts as update_ts from {rows} a join {rows} z using (item_id)"
        " where a.up = 1 and z.down = 1"
    )
