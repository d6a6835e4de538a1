"""Payload bodies to raw items, as column expressions.

Each parser gives array<map<string,string>>: values stay text and a missing field differs
from a null one. NULL stands for a page that cannot be read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfdiff.functions import text as tx
from shelfdiff.functions import times as tm

RAW_ITEMS = "array<map<string,string>>"

# Field names that an item must have.
CALLBACK_REQUIRED = ("itemid", "title", "url", "image", "price")
JSON_REQUIRED = ("id", "seller", "name", "thumbnails", "price", "status")
HTML_REQUIRED = ("id", "sellerid", "title", "href", "img", "price", "buynowprice", "endtime", "bid")


def callback_items(body: Column) -> Column:
    """JSON in a callback wrapper, items at kotohaco.result.items."""
    shape = f"struct<kotohaco:struct<result:struct<items:{RAW_ITEMS}>>>"
    return F.from_json(tx.strip_callback(body), shape)["kotohaco"]["result"]["items"]


def callback_fields(item: Column) -> dict[str, Column]:
    number = tx.to_price(item["itemid"]).cast("string")
    return {
        # ids are integers: 001 and 1 are the same item
        "item_id": F.coalesce(number, item["itemid"]),
        "title": item["title"],
        "item_url": item["url"],
        "image_url": item["image"],
        "price": tx.to_price(item["price"]),
    }


def json_items(body: Column) -> Column:
    """Plain JSON, items at data."""
    return F.from_json(body, f"struct<data:{RAW_ITEMS}>")["data"]


def json_fields(item: Column) -> dict[str, Column]:
    return {
        "item_id": item["id"],
        "seller_id": F.get_json_object(item["seller"], "$.id"),
        "title": item["name"],
        "item_url": tx.item_url(item["id"]),
        "image_url": tx.image_url(F.get_json_object(item["thumbnails"], "$[0]")),
        "price": tx.to_price(item["price"]),
        "onsale": tx.on_sale(item["status"]),
    }


# HTML result pages. `_REST` is the rest of a tag, with `>` allowed inside quotes.
_REST = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""


def _tag(name: str, css: str | None = None) -> str:
    if css is None:
        return rf"<{name}(?=[\s>]){_REST}"
    token = rf"""(?<![\w-]){css}(?![\w-])"""
    with_class = rf"""(?=[^>]*?\sclass\s*=\s*(?:"[^"]*{token}|'[^']*{token}|{css}[\s>]))"""
    return rf"<{name}(?=\s){with_class}{_REST}"


_DETAIL = _tag("div", "Product__detail")
_FEATURED = _tag("div", "Product__featured")
_EMPTY = _tag("div", "Empty")


_DIV = _tag("div")
_LINK = rf"(?s){_tag('h3')}.*?{_tag('a')}"
_BID = rf"(?s){_tag('span', 'Product__bid')}(.*?)</span>"


# Where each field comes from (tag, attribute).
ATTRIBUTES = {
    "id": ("div", "data-auction-id"),
    "sellerid": ("div", "data-auction-sellerid"),
    "price": ("div", "data-auction-price"),
    "buynowprice": ("div", "data-auction-buynowprice"),
    "endtime": ("div", "data-auction-endtime"),
    "title": ("link", "data-auction-title"),
    "href": ("link", "href"),
    "img": ("link", "data-auction-img"),
}


def _tags(block: Column) -> Column:
    """The three tags of a block that hold its fields."""
    return F.struct(
        F.regexp_extract(block, _DIV, 1).alias("div"),
        F.regexp_extract(block, _LINK, 2).alias("link"),
        F.regexp_extract(block, _BID, 0).alias("bid"),
    )


def _quoted_values(tags: Column) -> Column:
    """Attribute values with their quotes; empty text where the attribute is missing."""

    def quoted(tag: str, name: str) -> Column:
        pattern = rf"""(?s)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*')"""
        return F.regexp_extract(tags[tag], pattern, 1)

    values = [quoted(*source).alias(field) for field, source in ATTRIBUTES.items()]
    bid = F.regexp_replace(tags["bid"], r"<[^>]*>", "")
    return F.struct(*values, bid.alias("bid"), (tags["bid"] != "").alias("has_bid"))


def _html_item(values: Column) -> Column:
    pairs = {}
    for field in ATTRIBUTES:
        quoted = values[field]
        inner = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
        pairs[field] = F.when(quoted != "", tx.unescape_html(inner))
    pairs["bid"] = F.when(values["has_bid"], tx.unescape_html(values["bid"]))
    entries = [c for key, value in pairs.items() for c in (F.lit(key), value)]
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


def is_empty_page(html: Column) -> Column:
    """The site says that nothing was found."""
    return html.rlike(_EMPTY)


def is_promoted(block: Column) -> Column:
    return block.rlike(_FEATURED)


def product_blocks(html: Column) -> Column:
    """The text of each product block, promoted ones included; a block reaches up to the
    next one."""
    # All but the first piece: asking for their number would split the page once more. No
    # text has a billion tags, as it has two billion bytes at most.
    return F.slice(F.split(html, _DETAIL), F.lit(2), F.lit(1_000_000_000))


def html_items(body: Column) -> Column:
    """One item per product block; promoted blocks and no-result pages give none.

    For pages whose blocks follow each other without anything in between. Runs parse with
    `shelfdiff.sources.html`, which follows real nesting.
    """
    own = F.filter(product_blocks(body), lambda b: ~is_promoted(b))
    # Step by step, so that no regular expression runs twice on the same text.
    items = F.transform(F.transform(F.transform(own, _tags), _quoted_values), _html_item)
    return F.when(is_empty_page(body), F.array().cast(RAW_ITEMS)).otherwise(items)


def html_fields(item: Column) -> dict[str, Column]:
    return {
        "item_id": item["id"],
        "seller_id": item["sellerid"],
        "title": item["title"],
        "item_url": item["href"],
        "image_url": tx.clear_query(item["img"]),
        "price": tx.to_price(item["price"]),
        "full_price": tx.to_price(item["buynowprice"]),
        "bid_num": tx.bid_number(item["bid"]),
        "end_ts": tm.end_time(item["endtime"]),
    }
