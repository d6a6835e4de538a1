import json

import pytest

from pyspark.sql import functions as F

from shelfdiff import AUCTION, PRESENCE, STATUS, page_totals, project, table_ready
from shelfdiff.schema import PAYLOAD
from shelfdiff.sources.tables import find_id
from shelfdiff.sources import paging
from shelfdiff.sources.html import auction_items
from shelfdiff.sources.parsers import html_items
from shelfdiff.sources.payloads import parse_pages

from data import START


def payload(spark, site, pages):
    """pages: (keyword, page, status, body)"""
    return spark.createDataFrame([(site, START, *p) for p in pages], PAYLOAD)


def callback(items, last=None):
    js = {"last_page": last} if last else {}
    js["kotohaco"] = {"result": {"items": items}}
    return "callback(" + json.dumps(js, separators=(",", ":")) + ");"


ITEM = {"itemid": "001", "title": "t", "url": "u", "image": "i", "price": 1200}


def test_callback_pages(spark):
    pages = [
        ("k1", 1, 200, callback([ITEM, {**ITEM, "itemid": 2, "price": None}], 37)),
        ("k1", 2, 200, callback([{k: v for k, v in ITEM.items() if k != "price"}, ITEM])),
        ("k2", 1, 500, callback([ITEM], 9)),
        ("k3", 1, 200, callback([ITEM], 3)[:-20]),
        ("k4", 1, 200, 'callback({"kotohaco":{}});'),
        ("k5", 1, None, None),
        ("k6", 1, 200, callback([], 2)),
        ("k7", 1, 200, callback([{**ITEM, "itemid": None}])),
    ]
    df = payload(spark, PRESENCE.site, pages)
    observations, quarantine = project(df, PRESENCE)
    got = {(r["keyword"], r["page"], r["pos"]): (r["item_id"], r["price"]) for r in observations.collect()}
    assert got == {
        ("k1", 1, 0): ("1", 1200),
        ("k1", 1, 1): ("2", None),
        ("k1", 2, 1): ("1", 1200),
        ("k7", 1, 0): (None, 1200),
    }
    bad = {(r["keyword"], r["page"], r["pos"], r["reason"]) for r in quarantine.collect()}
    assert bad == {
        ("k1", 2, 0, "item"),
        ("k2", 1, None, "page"),
        ("k3", 1, None, "page"),
        ("k4", 1, None, "page"),
        ("k5", 1, None, "page"),
    }
    totals = page_totals(parse_pages(df, PRESENCE), PRESENCE).collect()[0]
    # planned pages: 12 of 37, failed 1, 3, 1, 1, 2, 1
    assert (totals["error"], totals["page"], totals["count"]) == (5, 12 + 1 + 3 + 1 + 1 + 2 + 1, 4)


def test_json_pages(spark):
    item = {"id": "m1", "seller": {"id": 7}, "name": "n", "thumbnails": ["https://t/x.jpg"], "price": "50"}
    on, off = {**item, "status": "on_sale"}, {**item, "id": "m2", "status": "trading"}
    pages = [
        ("k1", 1, 200, json.dumps({"data": [on, off]})),
        ("k2", 1, 200, json.dumps({"error": 1})),
        ("k3", 1, 200, json.dumps({"data": [item]})),
        ("k4", 1, 200, "not json"),
        ("k5", 1, 200, json.dumps({"data": []})),
    ]
    df = payload(spark, STATUS.site, pages)
    observations, quarantine = project(df, STATUS)
    rows = sorted((r["item_id"], r["seller_id"], r["price"], r["onsale"]) for r in observations.collect())
    assert rows == [("m1", "7", 50, 1), ("m2", "7", 50, 0)]
    assert observations.collect()[0]["image_url"].endswith("/photos/x.jpg")
    assert {(r["keyword"], r["reason"]) for r in quarantine.collect()} == {
        ("k2", "page"),
        ("k3", "item"),
        ("k4", "page"),
    }
    totals = page_totals(parse_pages(df, STATUS), STATUS).collect()[0]
    assert (totals["error"], totals["page"], totals["count"]) == (3, 5, 2)


def block(n, extra="", bid="12<i>x</i>", price="1200", now=""):
    return (
        f'<li><div class="a Product__detail b">{extra}<h3><span></span><a class="q" href="https://x/{n}"'
        f' data-auction-title="A &amp; &quot;{n}&quot; &gt;" data-auction-img="https://i/{n}.jpg?w=1#z">t</a></h3>'
        f"<div data-auction-id='x{n}' data-auction-sellerid=\"s\" data-auction-price=\"{price}\""
        f' data-auction-buynowprice="{now}" data-auction-endtime="1650000000"></div>'
        f'<span class="Product__bid">{bid}</span><br></div></li>'
    )


HTML = (
    '<html><body><div class="Product__details">no</div><ul>'
    + block(1)
    + block(2, '<div class="Product__featured">PR</div>')
    + block(3, price="1,200", now="0", bid="-")
    + "</ul></body></html>"
)


def test_html_pages(spark):
    pages = [
        ("k1", 1, 200, HTML),
        ("k2", 1, 200, '<div class="Empty">none</div>' + block(9)),
        ("k3", 1, 503, HTML),
        ("k4", 1, 200, ""),
        ("k5", 1, 200, '<div class="Product__detail"><div></div><h3><a></a></h3></div>'),
    ]
    df = payload(spark, AUCTION.site, pages)
    observations, quarantine = project(df, AUCTION)
    rows = {r["item_id"]: r for r in observations.collect()}
    assert set(rows) == {"x1", "x3"}
    one, three = rows["x1"], rows["x3"]
    assert (one["title"], one["price"], one["full_price"], one["bid_num"]) == ('A & "1" >', 1200, None, 12)
    assert one["image_url"] == "https://i/1.jpg#z"
    assert (three["price"], three["full_price"], three["bid_num"]) == (None, 0, -1)
    assert {(r["keyword"], r["reason"]) for r in quarantine.collect()} == {("k3", "page"), ("k5", "item")}
    totals = page_totals(parse_pages(df, AUCTION), AUCTION).collect()[0]
    assert (totals["error"], totals["page"], totals["count"]) == (2, 5, 2)


LONG = "aé日😀 &amp; " * 60_000


@pytest.mark.parametrize(
    "body", [HTML, "", '<div class="Empty"></div>' + block(1), block(4) * 3, block(LONG), LONG + block(5) + LONG]
)
def test_both_html_extractors_agree(spark, body):
    df = spark.createDataFrame([(body,)], "body string")
    found = df.select(html_items(F.col("body")).alias("items")).first()["items"]
    assert found == auction_items(body)


def test_nesting_extractor_ends_blocks_where_they_end():
    """What follows a closed block does not belong to it."""
    html = block(1) + '<div class="Product__featured">elsewhere</div>' + block(2)
    assert [i["id"] for i in auction_items(html)] == ["x1", "x2"]


def test_a_run_parses_pages_by_nesting(spark):
    """A promoted marker between two blocks hides neither of them."""
    between = block(1) + '<div class="Product__featured">elsewhere</div>' + block(2)
    observations, quarantine = project(payload(spark, AUCTION.site, [("k", 1, 200, between), ("l", 1, 200, None)]), AUCTION)
    assert {r["item_id"] for r in observations.collect()} == {"x1", "x2"}
    assert [(r["keyword"], r["reason"]) for r in quarantine.collect()] == [("l", "page")]


def test_page_plan_and_params(spark):
    df = spark.createDataFrame([("a", 37), ("b", None), ("c", 2), ("d", 0), ("e", -3)], "k string, last int")
    plan = paging.page_plan(df, F.col("last"), ["k"]).groupBy("k").count()
    assert {r["k"]: r["count"] for r in plan.collect()} == {"a": 12, "b": 1, "c": 2, "d": 1, "e": 1}
    sites = spark.createDataFrame(
        [(s, p) for s in (PRESENCE.site, STATUS.site, AUCTION.site) for p in (1, 3)], "site string, page int"
    )
    got = {(r["site"], r["page"]): (r["first_row"], r["n_rows"]) for r in paging.page_params(sites).collect()}
    assert got == {
        (PRESENCE.site, 1): (0, 100),
        (PRESENCE.site, 3): (200, 100),
        (STATUS.site, 1): (0, 120),
        (STATUS.site, 3): (0, 120),
        (AUCTION.site, 1): (1, 100),
        (AUCTION.site, 3): (201, 100),
    }


def test_newest_per_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        (F.col("id") * 7919 % 5000).alias("v"),
    )
    for n in (3, 1200):
        best = {}
        for r in df.collect():
            best.setdefault(r["k"], []).append(r["v"])
        expected = {(k, v, i) for k, vs in best.items() for i, v in enumerate(sorted(vs)[:n], start=1)}
        found = paging.newest_per_key(df, "k", [F.col("v")], n).collect()
        assert {(r["k"], r["v"], r["rank_no"]) for r in found} == expected and len(found) == len(expected)


def test_keywords(spark):
    config = paging.keywords_text({"a": ["x", "日"], "b": []})
    df = spark.createDataFrame([(config,)], "c string")
    rows = df.select(F.inline(paging.keywords(F.col("c")))).collect()
    assert [(r["site"], r["keyword"]) for r in rows] == [("a", "x"), ("a", "日")]


def test_table_ready(spark, tmp_path):
    empty, full = str(tmp_path / "empty"), str(tmp_path / "full")
    spark.range(0).write.parquet(empty)
    spark.range(1).write.parquet(full)
    assert not table_ready(spark, empty)
    assert not table_ready(spark, str(tmp_path / "missing"))
    assert table_ready(spark, full)


def test_find_id_takes_the_type_of_the_column(spark):
    listing = spark.createDataFrame([("s", "m123", 17), ("t", "m123", 18)], "site string, item_id string, n bigint")
    assert find_id(listing, 17).isEmpty()
    assert find_id(listing, "m123", site="t").first()["n"] == 18
    assert find_id(listing, "17", "n").first()["site"] == "s"
    assert find_id(listing, "x", "n").isEmpty()
