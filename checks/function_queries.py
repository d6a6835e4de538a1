"""Scalar functions and exclusion rules over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.source_queries import part_listing
from shelfdiff import add_rule, apply_rules, get_rules, remove_rule
from shelfdiff.functions import text as tx
from shelfdiff.functions import times as tm

A = fx.A


def item_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages")
    name = F.substring_index("url", "/", -1)
    return pages.select("page_id", tx.item_url(name).alias("item_url"))


def image_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.image_url(F.col("url")).alias("image_url"))


def clear_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.clear_query(F.col("url")).alias("url"))


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _by_type(**texts: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, text in texts.items():
        out = F.when(F.col("event_type") == kind, text).otherwise(out)
    return out


def bid_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid texts made of the event values: with a unit, bare, empty, a sign, a decimal."""
    bids = F.floor(F.col("value")).cast("string")
    text = _by_type(
        view=F.concat(bids, F.lit("x")),
        click=bids,
        signup=F.lit("-"),
        error=F.lit(""),
        purchase=F.concat(bids, F.lit(".9")),
    )
    events = fx.table(spark, sf_dir, "events").withColumn("bid_text", text)
    return events.select("event_id", "bid_text", tx.bid_number(F.col("bid_text")).alias("bids"))


def coerce_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price texts made of the event values: plain, empty, grouped, zero-led, decimal."""
    cents = _cents()
    text = _by_type(
        view=cents.cast("string"),
        click=F.lit(""),
        signup=F.concat(F.floor(cents / 1000).cast("string"), F.lit(","), F.lpad((cents % 1000).cast("string"), 3, "0")),
        error=F.concat(F.lit("00"), cents.cast("string")),
        purchase=F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")),
    )
    events = fx.table(spark, sf_dir, "events").withColumn("price_text", text)
    return fx.plain(
        events.select("event_id", "price_text", tx.to_price(F.col("price_text")).alias("price_read"))
    )


def onsale_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "sold_out").otherwise("on_sale")
    events = fx.table(spark, sf_dir, "events").withColumn("status", status)
    return events.select("event_id", "status", tx.on_sale(F.col("status")).alias("flag"))


def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.events(spark, sf_dir)
    return events.select(
        "event_id",
        tm.local_time(F.col("ts")).alias("tokyo"),
        tm.local_time(F.col("ts"), "America/St_Johns").alias("st_johns"),
    )


def end_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing times as epoch text with a fraction; one event type has none to read."""
    micros = F.unix_micros("ts")
    epoch = F.concat(
        F.floor(micros / 1_000_000).cast("string"),
        F.lit("."),
        F.lpad((micros % 1_000_000).cast("string"), 6, "0"),
    )
    text = F.when(F.col("event_type") == "click", "soon").otherwise(epoch)
    read = tm.end_time(text)
    return fx.events(spark, sf_dir).select(
        "event_id", F.unix_micros(read).cast("string").alias("end_us")
    )


def ended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the stored listing whose closing time the newest run is past."""
    state = fx.run_and_state(spark, sf_dir, fx.AUCTION)
    run, _, listing = state
    closed = listing.filter(tm.ended(F.col("end_ts"), F.lit(run.run_ts)))
    return fx.plain(closed.select("item_id", "end_ts", "price"))


def split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into message parts; parts are compared by length and digest."""
    docs = fx.table(spark, sf_dir, "documents")
    parts = docs.select("doc_id", F.posexplode(tx.split_text(F.col("text"))).alias("part_no", "part"))
    return parts.select(
        "doc_id", "part_no", F.length("part").alias("part_len"), F.md5("part").alias("part_md5")
    )


RULES = [
    (1, A, "price >= 1000"),
    (2, A, "seller_id = 'Brand#2'"),
    (3, A, "full_price > 0"),
    (4, fx.B, "price >= 0"),
]


def _rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "rule_id bigint, site string, predicate string")


def blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule is NULL for every row and one belongs to another site: neither hits."""
    kept, _ = apply_rules(part_listing(spark, sf_dir), _rules(spark), A)
    return kept.select("item_id", "title", "seller_id", "price")


def blacklist_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, hits = apply_rules(part_listing(spark, sf_dir), _rules(spark), A)
    return hits


def brand_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table out of `part`: one rule per brand, sites by the brand's number."""
    brands = fx.table(spark, sf_dir, "part").select("p_brand").distinct()
    number = F.substring_index("p_brand", "#", -1).cast("bigint")
    site = F.when(number <= 10, A).otherwise(fx.B)
    predicate = F.concat(F.lit("seller_id = '"), F.col("p_brand"), F.lit("'"))
    return brands.select(number.alias("rule_id"), site.alias("site"), predicate.alias("predicate"))


def rules_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three ways to ask, in one result."""
    rules = brand_rules(spark, sf_dir)
    asked = {
        "all": get_rules(rules, rule_id=1, site=A, show_all=True),
        "site": get_rules(rules, rule_id=1, site=A),
        "id": get_rules(rules, rule_id=2),
    }
    out = None
    for name, found in asked.items():
        found = found.withColumn("asked", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


def rules_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = brand_rules(spark, sf_dir)
    added = add_rule(rules, A, "price >= 20000", part_listing(spark, sf_dir))
    return remove_rule(added, 2)


QUERIES = {
    "item_url": item_url,
    "image_url": image_url,
    "clear_query": clear_query,
    "bid_num": bid_num,
    "coerce_prices": coerce_prices,
    "onsale_flag": onsale_flag,
    "local_time": local_time,
    "end_time": end_time,
    "ended": ended,
    "split_text": split_text,
    "blacklist_filter": blacklist_filter,
    "blacklist_hits": blacklist_hits,
    "rules_get": rules_get,
    "rules_edit": rules_edit,
}

_BRANDS = f"""with rules as (
  select distinct cast(split_part(p_brand, '#', 2) as bigint) as rule_id,
         case when cast(split_part(p_brand, '#', 2) as bigint) <= 10 then '{A}' else '{fx.B}' end as site,
         'seller_id = ''' || p_brand || '''' as predicate
  from part)"""
_HIT = "cast(round(p_retailprice) as bigint) >= 1000 or p_brand = 'Brand#2'"

# One recursion per document: while more than 4096 characters are left, cut at the last
# newline of the first 4096, else after 4096.
_SPLIT = """with recursive cut as (
  select doc_id, -1 as part_no, cast('' as varchar) as part, text as rest, true as more from documents
  union all
  select doc_id, part_no + 1,
    case when length(rest) <= 4096 then rest
         when contains(substr(rest, 1, 4096), chr(10))
           then substr(rest, 1, 4096 - instr(reverse(substr(rest, 1, 4096)), chr(10)))
         else substr(rest, 1, 4096) end,
    case when length(rest) <= 4096 then ''
         when contains(substr(rest, 1, 4096), chr(10))
           then substr(rest, 4096 - instr(reverse(substr(rest, 1, 4096)), chr(10)) + 2)
         else substr(rest, 4097) end,
    length(rest) > 4096
  from cut where more)
select doc_id, part_no, cast(length(part) as int) as part_len, md5(part) as part_md5 from cut where part_no >= 0"""

_OFFSET = "'-03:30'"

ORACLES = {
    "item_url": f"select page_id, '{tx.ITEM_URL}' || split_part(url, '/', -1) as item_url from pages",
    "image_url": f"select page_id, '{tx.PHOTO_URL}' || split_part(url, '/', -1) as image_url from pages",
    "clear_query": r"""select page_id, case when instr(split_part(url, '#', 1), '?') > 0
      then split_part(split_part(url, '#', 1), '?', 1) || substr(url, length(split_part(url, '#', 1)) + 1)
      else url end as url from pages""",
    "bid_num": """with t as (select event_id, cast(cast(floor(value) as bigint) as varchar) as n, event_type
        from events),
      b as (select event_id, event_type, n, case event_type when 'view' then n || 'x' when 'click' then n
        when 'signup' then '-' when 'error' then '' when 'purchase' then n || '.9' end as bid_text from t)
      select event_id, bid_text, cast(case event_type when 'view' then cast(n as int)
        when 'click' then case when length(n) = 1 then cast(n as int)
          else cast(substr(n, 1, length(n) - 1) as int) end else -1 end as int) as bids from b""",
    "coerce_prices": """with t as (select event_id, event_type, cast(round(value * 100) as bigint) as c from events)
      select event_id, case event_type when 'view' then cast(c as varchar) when 'click' then ''
        when 'signup' then (c // 1000) || ',' || lpad(cast(c % 1000 as varchar), 3, '0')
        when 'error' then '00' || c
        when 'purchase' then (c // 100) || '.' || lpad(cast(c % 100 as varchar), 2, '0') end as price_text,
      cast(case when event_type in ('view', 'error') then c
        when event_type = 'purchase' and c % 100 = 0 then c // 100 end as varchar) as price_read from t""",
    "onsale_flag": """select event_id, case when event_type = 'purchase' then 'sold_out' else 'on_sale' end
      as status, case when event_type = 'purchase' then 0 else 1 end as flag from events""",
    "local_time": f"""select event_id,
      strftime(ts + interval 9 hour, '%Y-%m-%d %H:%M:%S') || '+09:00' as tokyo,
      strftime(ts - interval 210 minute, '%Y-%m-%d %H:%M:%S') || {_OFFSET} as st_johns from events""",
    "end_time": """select event_id, case when event_type <> 'click'
      then cast(epoch_us(ts) as varchar) end as end_us from events""",
    "ended": "with " + fx.views(fine=True) + "," + fx.RUN_SQL + ", state as (" + fx.state_sql(fx.C)
    + ") select item_id, " + fx.time_text("end_ts")
    + ", price from state where end_ts <= (select run_ts from run)",
    "split_text": _SPLIT,
    "blacklist_filter": f"""select cast(p_partkey as varchar) as item_id, p_name as title,
      p_brand as seller_id, cast(round(p_retailprice) as bigint) as price from part where not ({_HIT})""",
    "blacklist_hits": f"select count(*) as hits from part where {_HIT}",
    "rules_get": _BRANDS + f""" select *, 'all' as asked from rules union all
      select *, 'site' from rules where site = '{A}' union all select *, 'id' from rules where rule_id = 2""",
    "rules_edit": _BRANDS + f""" select * from rules where rule_id <> 2 union all
      select max(rule_id) + 1, '{A}', 'price >= 20000' from rules""",
}
