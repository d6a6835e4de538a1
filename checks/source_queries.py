"""Payload parsing: bodies are packed by Spark from the given tables and read back.

    documents   one page per document, one item per line of its whole text
    events      one page per event; pages of faulty days are cut off halfway, click pages
                lack the item list, items of error pages lack their price
    pages       raw HTML
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from shelfdiff import PRESENCE, PROFILES, STATUS, Profile, project, table_ready
from shelfdiff.functions import text as tx
from shelfdiff.operators.dedup import dedup_first
from shelfdiff.schema import LISTING
from shelfdiff.session import scratch_path
from shelfdiff.sources import html, paging, parsers, payloads
from shelfdiff.sources.tables import Store, find_id

A, B, C = fx.A, fx.B, fx.C

# Item ids of a document's lines: document number and line number in one integer.
LINES = 1_000_000


def _number(doc: Column, line: Column) -> Column:
    return doc * LINES + line


def _lines(item) -> Column:
    return F.transform(F.split("text", "\n"), lambda text, i: item(text, i))


def _payload(df: DataFrame, site: str, body: Column, keyword: Column) -> DataFrame:
    return df.select(
        F.lit(site).alias("site"),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("run_ts"),
        keyword.cast("string").alias("keyword"),
        F.lit(1).alias("page"),
        F.lit(200).alias("status"),
        body.alias("body"),
    )


def callback_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")

    def item(text: Column, i: Column) -> Column:
        return F.struct(
            _number(F.col("doc_id"), i).alias("itemid"),
            text.alias("title"),
            F.concat(F.lit("/item/"), i.cast("string")).alias("url"),
            F.lit("/img.jpg").alias("image"),
            F.length(text).alias("price"),
        )

    items = F.struct(F.struct(_lines(item).alias("items")).alias("result"))
    last = F.size(F.split("text", "\n"))
    body = F.to_json(F.struct(last.alias("last_page"), items.alias("kotohaco")))
    return _payload(docs, A, F.concat(F.lit("callback("), body, F.lit(");")), F.col("doc_id"))


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")

    def item(text: Column, i: Column) -> Column:
        return F.struct(
            F.concat(F.lit("m"), _number(F.col("doc_id"), i).cast("string")).alias("id"),
            F.struct(F.col("source").alias("id")).alias("seller"),
            text.alias("name"),
            F.array(F.concat(F.lit("https://t.example/thumb/"), i.cast("string"), F.lit(".jpg"))).alias(
                "thumbnails"
            ),
            F.length(text).alias("price"),
            F.when(F.length(text) > 40, "on_sale").otherwise("sold_out").alias("status"),
        )

    return _payload(docs, B, F.to_json(F.struct(_lines(item).alias("data"))), F.col("doc_id"))


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages with one product block per line; long lines are promoted blocks, and
    one-line documents stand for pages without results."""
    docs = fx.table(spark, sf_dir, "documents")

    def block(text: Column, i: Column) -> Column:
        number = _number(F.col("doc_id"), i).cast("string")
        promoted = F.when(F.length(text) > 200, '<div class="Product__featured">PR</div>').otherwise("")
        return F.concat(
            F.lit('<li class="Product"><div class="Product__detail"><h3 class="Product__title"><a class="l" data-auction-title="'),
            _escaped(text),
            F.lit('" href="https://a.example/'),
            number,
            F.lit('" data-auction-img="https://i.example/'),
            number,
            F.lit('.jpg?w=300&amp;h=300#x">link</a></h3><div class="Product__bonus" data-auction-id="x'),
            number,
            F.lit('" data-auction-sellerid="'),
            F.col("source"),
            F.lit('" data-auction-price="'),
            F.length(text).cast("string"),
            F.lit('" data-auction-buynowprice="'),
            F.when(F.length(text) > 80, (F.length(text) * 2).cast("string")).otherwise(""),
            F.lit('" data-auction-endtime="'),
            (F.length(text) + 1_700_000_000).cast("string"),
            F.lit('"></div>'),
            promoted,
            F.lit('<span class="Product__bid">'),
            F.length(text).cast("string"),
            F.lit("<i>x</i></span></div></li>"),
        )

    blocks = F.array_join(_lines(block), "\n")
    empty = F.when(F.contains("text", F.lit("\n")), "").otherwise('<div class="Empty">0</div>')
    body = F.concat(F.lit("<html><body>"), empty, F.lit("<ul>"), blocks, F.lit("</ul></body></html>"))
    return _payload(docs, C, body, F.col("doc_id"))


def event_pages(spark: SparkSession, sf_dir: str, site: str, errors: bool = True) -> DataFrame:
    """A page per event. Without `errors` all pages list their item with its price; those
    of faulty days are cut off in any case, or were not fetched where cutting HTML would
    leave readable pages."""
    e = fx.events(spark, sf_dir)
    cents = F.round(F.col("value") * 100).cast("bigint")
    price = F.when(F.col("event_type") != "error", cents) if errors else cents
    user = F.col("user_id").cast("string")
    head = tail = ""
    if site == A:
        item = F.struct(
            F.col("user_id").alias("itemid"),
            F.col("event_type").alias("title"),
            F.lit("/u").alias("url"),
            F.lit("/i").alias("image"),
            price.alias("price"),
        )
        inner = F.struct(F.struct(F.array(item).alias("items")).alias("result"))
        listed = F.to_json(F.struct((F.hour("ts") + 1).alias("last_page"), inner.alias("kotohaco")))
        bare = F.to_json(F.struct((F.hour("ts") + 1).alias("last_page")))
        head, tail = "callback(", ");"
    elif site == B:
        status = F.lit("on_sale") if errors else F.when(F.col("event_type") != "purchase", "on_sale").otherwise("sold_out")
        item = F.struct(
            user.alias("id"),
            F.struct(F.col("event_type").alias("id")).alias("seller"),
            F.col("event_type").alias("name"),
            F.array(F.lit("https://t.example/a.jpg")).alias("thumbnails"),
            price.alias("price"),
            status.alias("status"),
        )
        listed, bare = F.to_json(F.struct(F.array(item).alias("data"))), F.to_json(F.struct(F.lit("none").alias("error")))
    else:
        bids = F.when(F.col("event_type") == "view", 0).otherwise(F.floor(F.col("value") / 10))
        ends = F.unix_seconds("ts") + 36 * 3600
        with_price = F.concat(F.lit('" data-auction-price="'), price.cast("string"))
        listed = F.concat(
            F.lit('<ul><li><div class="Product__detail"><div data-auction-id="'),
            user,
            F.lit('" data-auction-sellerid="'),
            F.col("event_type"),
            F.coalesce(with_price, F.lit("")),
            F.lit('" data-auction-buynowprice="" data-auction-endtime="'),
            ends.cast("string"),
            F.lit('"></div><h3><a data-auction-title="'),
            F.col("event_type"),
            F.lit('" href="/u" data-auction-img="/i"></a></h3><span class="Product__bid">'),
            bids.cast("string"),
            F.lit("<i>x</i></span></div></li></ul>"),
        )
        # A page that says there are no results is no error.
        bare = F.lit('<div class="Empty">0</div>')
    text = F.when(F.col("event_type") == "click", bare).otherwise(listed) if errors else listed
    body = F.concat(F.lit(head), text, F.lit(tail))
    cut = F.substring(body, F.lit(1), F.length(body) - 12) if site != C else F.lit(None).cast("string")
    faulty = F.day("run_ts") % 5 == 0
    return e.select(
        F.lit(site).alias("site"),
        "run_ts",
        F.col("event_id").cast("string").alias("keyword"),
        F.lit(1).alias("page"),
        F.when(faulty & F.lit(site == C), 500).otherwise(200).alias("status"),
        F.when(faulty, cut).otherwise(body).alias("body"),
    )


# Queries.


def src_jsonp(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = callback_pages(spark, sf_dir)
    body = F.col("body")
    items = parsers.callback_items(body)
    return pages.select(
        "keyword",
        tx.page_count(tx.strip_callback(body)).alias("last_page"),
        F.size(items).alias("n_items"),
        items[0]["itemid"].alias("first_id"),
    )


def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = parsers.json_items(F.col("body"))
    return json_pages(spark, sf_dir).select(
        "keyword", F.size(items).alias("n_items"), items[0]["id"].alias("first_id")
    )


def _items(spark: SparkSession, pages: DataFrame, profile: Profile) -> DataFrame:
    observations, _ = project(pages, profile)
    return fx.plain(observations.drop("site", "run_ts", "page"))


def items_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _items(spark, callback_pages(spark, sf_dir), PRESENCE)
    return rows.select("keyword", "pos", "item_id", "title", "item_url", "image_url", "price")


def items_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _items(spark, json_pages(spark, sf_dir), STATUS)
    return rows.select(
        "keyword", "pos", "item_id", "seller_id", "title", "item_url", "image_url", "price", "onsale"
    )


def items_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, html_pages(spark, sf_dir), PROFILES[C]).drop("onsale")


def items_c_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages through the extractor that follows nesting."""
    fields = ", ".join(f"{f} string" for f in html.AUCTION_FIELDS)
    rows = html.extract(html_pages(spark, sf_dir), "keyword", "body", html.auction_items, fields)
    known = parsers.html_fields(F.struct(*html.AUCTION_FIELDS))
    columns = [value.alias(name) for name, value in known.items()]
    return fx.plain(rows.select("keyword", *columns))


def drop_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promoted and other blocks of every result page."""
    blocks = parsers.product_blocks(F.col("body"))
    kept = F.filter(blocks, lambda b: ~parsers.is_promoted(b))
    return html_pages(spark, sf_dir).select(
        "keyword", F.size(blocks).alias("n_blocks"), F.size(kept).alias("n_kept")
    )


def drop_empty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_pages(spark, sf_dir).filter(~parsers.is_empty_page(F.col("body")))
    return pages.select("keyword")


# Fixed shape of the given pages: advertisement blocks and links.
_AD = r'<div class="ad">.*?</div>'
_HREF = r'<a\s[^>]*?href="([^"]*)"'


def src_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and links of raw pages with advertisement blocks cut out."""
    body = F.regexp_replace("html", "(?s)" + _AD, "")
    links = F.regexp_extract_all(body, F.lit(_HREF), F.lit(1))
    title = F.regexp_extract(body, "(?s)<title>(.*?)</title>", 1)
    rows = fx.table(spark, sf_dir, "pages").select(
        "page_id", tx.unescape_html(title).alias("title"), F.posexplode(links).alias("pos", "href")
    )
    return fx.plain(rows.withColumn("href", tx.unescape_html(F.col("href"))))


def src_html_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.table(spark, sf_dir, "pages")
    rows = html.extract(pages, "page_id", "html", html.page_links, "title string, pos int, href string")
    return fx.plain(rows)


def _bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for profile in PROFILES.values():
        _, quarantine = project(event_pages(spark, sf_dir, profile.site), profile)
        out = quarantine if out is None else out.unionByName(quarantine)
    return out


def bad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plain(_bad(spark, sf_dir).drop("page"))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for profile in PROFILES.values():
        pages = payloads.parse_pages(event_pages(spark, sf_dir, profile.site), profile)
        totals = payloads.page_totals(pages, profile)
        out = totals if out is None else out.unionByName(totals)
    return out


def _total(column: str):
    return lambda spark, sf_dir: fx.plain(_totals(spark, sf_dir).select("site", "run_ts", column))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items before and after de-duplication."""
    out = None
    for profile in PROFILES.values():
        observations, _ = project(event_pages(spark, sf_dir, profile.site), profile)
        before = observations.groupBy("site", "run_ts").agg(F.count("*").alias("count"))
        after = dedup_first(observations).groupBy("site", "run_ts").agg(F.count("*").alias("items"))
        both = before.join(after, ["site", "run_ts"])
        out = both if out is None else out.unionByName(both)
    return fx.plain(out)


def _plan(spark: SparkSession, sf_dir: str, sites) -> DataFrame:
    """One keyword per user and site; the first page tells the last one in its text."""
    per_user = fx.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    body = F.concat(F.lit('{"last_page":'), F.ceil(F.col("n") / 5).cast("string"), F.lit("}"))
    first = per_user.select(
        F.explode(F.array(*[F.lit(s) for s in sites])).alias("site"), "user_id", body.alias("body")
    )
    return paging.page_plan(first, tx.page_count(F.col("body")), ["site", "user_id"])


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, (A,))


def page_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page_params(_plan(spark, sf_dir, fx.SITES))


def _newest() -> list[Column]:
    return [F.col("o_orderdate").desc(), F.col("o_orderkey")]


def page_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    rows = paging.page_window(orders, _newest(), page=3)
    return rows.select("o_orderkey", "o_custkey", fx.day("o_orderdate").alias("o_orderdate"))


def topn_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    rows = paging.newest_per_key(orders, "o_orderpriority", _newest(), paging.PAGE_SIZE[B])
    return rows.select("o_orderpriority", "o_orderkey", "rank_no")


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration per document: its source with its lines as keywords."""
    docs = fx.table(spark, sf_dir, "documents")
    config = F.to_json(F.create_map("source", F.split("text", "\n")))
    return docs.select("doc_id", config.alias("config")).select(
        "doc_id", F.inline(paging.keywords(F.col("config")))
    )


def part_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as a presence listing."""
    known = {
        "site": F.lit(A),
        "item_id": F.col("p_partkey"),
        "title": F.col("p_name"),
        "seller_id": F.col("p_brand"),
        "price": F.round("p_retailprice"),
    }
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING]
    return fx.table(spark, sf_dir, "part").select(*columns)


def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as a committed listing version and read through the store."""
    store = Store(spark, scratch_path(spark, "store"))
    run_ts = spark.sql("select timestamp'2024-01-01 00:00:00' as t").first()["t"]
    store.write_version(part_listing(spark, sf_dir), A, run_ts)
    log = fx.runs(spark, sf_dir, (A,)).agg(F.sum("count").alias("count"))
    zero = {c: F.lit(0) for c in ("error", "page", "new", "discount", "sold")}
    store.append_log(log.withColumns({"site": F.lit(A), "run_ts": F.lit(run_ts), **zero}))
    return store.listing(A).select("item_id", "title", "seller_id", "price")


def find_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part")
    return find_id(part, 17, "p_partkey").select("p_partkey", "p_name", "p_brand")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def ready_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [(t, table_ready(spark, f"{sf_dir}/{t}.parquet")) for t in (*TABLES, "missing")]
    return spark.createDataFrame(found, "table_name string, ready boolean")


QUERIES = {
    "src_jsonp": src_jsonp,
    "src_json": src_json,
    "src_html": src_html,
    "src_html_udf": src_html_udf,
    "items_a": items_a,
    "items_b": items_b,
    "items_c": items_c,
    "items_c_nested": items_c_nested,
    "drop_promoted": drop_promoted,
    "drop_empty_pages": drop_empty_pages,
    "bad_pages": bad_pages,
    "run_errors": _total("error"),
    "run_pages": _total("page"),
    "run_counts": run_counts,
    "page_plan": page_plan,
    "page_params": page_params,
    "page_window": page_window,
    "topn_newest": topn_newest,
    "keywords": keywords,
    "listing_scan": listing_scan,
    "find_id": find_part,
    "table_ready": ready_tables,
}

_DOC_LINES = f"""
with lines as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as title,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos
  from documents),
items as (select *, doc_id * {LINES} + pos as number, length(title) as price from lines)
"""
_HTML_ITEMS = """select cast(doc_id as varchar) as keyword, cast(pos as varchar) as pos,
  'x' || number as item_id, source as seller_id, title, 'https://a.example/' || number as item_url,
  'https://i.example/' || number || '.jpg#x' as image_url, price,
  case when price > 80 then cast(price * 2 as varchar) end as full_price,
  cast(price as varchar) as bid_num,
  strftime(to_timestamp(price + 1700000000) at time zone 'UTC', '%Y-%m-%d %H:%M:%S.%f') as end_ts
from items where price <= 200 and contains(text, chr(10))"""
_DECODED = "replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_LINK_ITEMS = f"""
with cut as (select page_id, regexp_replace(html, '{_AD}', '', 'gs') as html from pages),
found as (select page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') as title,
                 regexp_extract_all(html, '{_HREF}', 1) as links from cut)
select page_id, {_DECODED} as title, unnest(links) as href,
       cast(generate_subscripts(links, 1) - 1 as varchar) as pos from found"""

_EVENT_DAYS = f"""
with e as (select *, date_trunc('day', ts)::timestamp as run_ts,
                  extract(day from ts) % 5 = 0 as faulty, event_type = 'click' as bare from events),
sites as (select unnest(['{A}', '{B}', '{C}']) as site)"""
# An item without a price field is left out; JSON text drops NULL fields.
_GOOD = "not faulty and not bare and event_type <> 'error'"
# An auction page without results is no error.
_BAD = f"not ({_GOOD}) and (faulty or not bare or site <> '{C}')"


def _event_totals(columns: str) -> str:
    return (
        _EVENT_DAYS + f" select site, {fx.time_text('run_ts')}, {columns}"
        " from e join sites on true group by site, run_ts"
    )


ORACLES = {
    "src_jsonp": _DOC_LINES + f"""select cast(doc_id as varchar) as keyword,
      count(*) as last_page, cast(count(*) as int) as n_items,
      cast(doc_id * {LINES} as varchar) as first_id from items group by doc_id""",
    "src_json": _DOC_LINES + f"""select cast(doc_id as varchar) as keyword, cast(count(*) as int) as n_items,
      'm' || (doc_id * {LINES}) as first_id from items group by doc_id""",
    "src_html": _LINK_ITEMS,
    "src_html_udf": _LINK_ITEMS,
    "items_a": _DOC_LINES + """select cast(doc_id as varchar) as keyword, cast(pos as varchar) as pos,
      cast(number as varchar) as item_id, title, '/item/' || pos as item_url,
      '/img.jpg' as image_url, price from items""",
    "items_b": _DOC_LINES + f"""select cast(doc_id as varchar) as keyword, cast(pos as varchar) as pos,
      'm' || number as item_id, source as seller_id, title, '{tx.ITEM_URL}m' || number as item_url,
      '{tx.PHOTO_URL}' || pos || '.jpg' as image_url, price,
      case when price > 40 then '1' else '0' end as onsale from items""",
    "items_c_nested": _DOC_LINES + f"select * exclude (pos) from ({_HTML_ITEMS})",
    "items_c": _DOC_LINES + """, numbered as (select *, row_number() over (partition by doc_id order by pos) - 1 as kept
       from items where price <= 200 and contains(text, chr(10)))
       """ + _HTML_ITEMS.replace("cast(pos as", "cast(kept as").replace("from items", "from numbered"),
    "drop_promoted": _DOC_LINES + """select cast(doc_id as varchar) as keyword, cast(count(*) as int) as n_blocks,
      cast(count(*) filter (where price <= 200) as int) as n_kept from items group by doc_id""",
    "drop_empty_pages": "select cast(doc_id as varchar) as keyword from documents where contains(text, chr(10))",
    "bad_pages": _EVENT_DAYS + f""" select site, {fx.time_text('run_ts')}, cast(event_id as varchar) as keyword,
      case when faulty or bare then null else '0' end as pos,
      case when faulty or bare then 'page' else 'item' end as reason
      from e join sites on true where {_BAD}""",
    "run_errors": _event_totals(f"count(*) filter (where {_BAD}) as error"),
    "run_pages": _event_totals(
        f"cast(case when site = '{A}' then sum(case when faulty and bare then 1"
        " else least(extract(hour from ts) + 1, 12) end) else count(*) end as bigint) as page"
    ),
    "run_counts": _EVENT_DAYS + f""" select site, {fx.time_text('run_ts')}, count(*) as count,
      count(distinct user_id) as items from e join sites on true where {_GOOD} group by site, run_ts""",
    "page_plan": f"""with u as (select user_id, cast(least(ceil(count(*) / 5), 12) as int) as last
      from events group by user_id)
      select '{A}' as site, user_id, cast(unnest(generate_series(1, last)) as int) as page from u""",
    "page_params": f"""with u as (select user_id, cast(least(ceil(count(*) / 5), 12) as int) as last
      from events group by user_id),
      p as (select user_id, cast(unnest(generate_series(1, last)) as int) as page from u)
      select '{A}' as site, user_id, page, cast((page - 1) * 100 as int) as first_row, 100 as n_rows from p
      union all select '{B}', user_id, page, 0, 120 from p
      union all select '{C}', user_id, page, (page - 1) * 100 + 1, 100 from p""",
    "page_window": """select o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate
      from (select *, row_number() over (order by o_orderdate desc, o_orderkey) as n from orders)
      where n between 201 and 300""",
    "topn_newest": """select o_orderpriority, o_orderkey, cast(rank_no as int) as rank_no from (select *, row_number() over
      (partition by o_orderpriority order by o_orderdate desc, o_orderkey) as rank_no from orders)
      where rank_no <= 120""",
    "keywords": """select doc_id, source as site, unnest(string_split(text, chr(10))) as keyword
      from documents""",
    "listing_scan": """select cast(p_partkey as varchar) as item_id, p_name as title,
      p_brand as seller_id, cast(round(p_retailprice) as bigint) as price from part""",
    "find_id": "select p_partkey, p_name, p_brand from part where p_partkey = 17",
    "table_ready": " union all ".join(
        f"select '{t}' as table_name, count(*) > 0 as ready from {t}" for t in TABLES
    )
    + " union all select 'missing', false",
}
