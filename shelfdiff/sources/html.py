"""HTML extraction by nesting, for pages that regular expressions cannot cut.

Each page is parsed in one pass over its tags, in whatever partition Spark put it: as rows by `extract`, or as a column that a profile can parse pages with.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.session import ship
from shelfdiff.sources.markup import raw_end, tags
from shelfdiff.sources.parsers import ATTRIBUTES

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

# Records are handed on in pieces of about this many.
PIECE = 5_000

AUCTION_FIELDS = ("id", "sellerid", "price", "buynowprice", "endtime", "title", "href", "img", "bid")


# Elements whose content is no markup.
RAW = ("script", "style")

_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


def _attributes(text: str) -> dict[str, str]:
    """Attribute values by name, the first of equal names, references decoded."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class _Walker:
    """Keeps the stack of open elements; a stray end tag closes back to its opener.

    Attributes are read of the tags in `reads` (None: of all), text only where `listens`."""

    reads: frozenset[str] | None = frozenset()

    def __init__(self) -> None:
        self.open: list[str] = []
        self._count: dict[str, int] = {}  # open elements by tag

    def entered(self, tag: str, attrs: dict[str, str]) -> None: ...

    def left(self, depth: int) -> None: ...

    def listens(self) -> bool:
        return False

    def heard(self, text: str) -> None: ...

    def feed(self, page: str) -> None:
        at = 0
        for start, end, closes, name, attributes in tags(page):
            if start < at:
                continue  # inside an element without markup
            if start > at and self.listens():
                self.heard(unescape(page[at:start]))
            at = end
            if not name:
                continue
            tag = name.lower()
            if closes:
                self._end(tag)
                continue
            self.entered(tag, _attributes(attributes) if self.reads is None or tag in self.reads else {})
            if tag in RAW:
                at = raw_end(page, tag, at)
            elif tag not in VOID:
                self.open.append(tag)
                self._count[tag] = self._count.get(tag, 0) + 1
        if at < len(page) and self.listens():
            self.heard(unescape(page[at:]))

    def _end(self, tag: str) -> None:
        if not self._count.get(tag):
            return
        while self.open:
            closed = self.open.pop()
            self._count[closed] -= 1
            self.left(len(self.open))
            if closed == tag:
                break


class _Products(_Walker):
    """Product blocks of an auction result page."""

    reads = frozenset(("div", "a", "span"))

    def __init__(self) -> None:
        super().__init__()
        self.empty = False
        self.items: list[dict] = []
        self._block: dict | None = None
        self._depth = self._heading = self._bid = -1

    def entered(self, tag, attrs):
        css = attrs.get("class", "").split()
        if tag == "div" and "Empty" in css:
            self.empty = True
        block = self._block
        if block is None:
            if tag == "div" and "Product__detail" in css:
                self._block, self._depth = {}, len(self.open)
                self._heading = self._bid = -1
            return
        if tag == "div":
            if "Product__featured" in css:
                block["_promoted"] = True
            if "_div" not in block:
                block["_div"] = True
                self._keep(attrs, "div")
        elif tag == "h3" and "_h3" not in block:
            block["_h3"], self._heading = True, len(self.open)
        elif tag == "a" and self._heading >= 0 and "_a" not in block:
            block["_a"] = True
            self._keep(attrs, "link")
        elif tag == "span" and "Product__bid" in css and "bid" not in block:
            block["bid"], self._bid = "", len(self.open)

    def _keep(self, attrs: dict[str, str], of: str) -> None:
        for field, (tag, name) in ATTRIBUTES.items():
            if tag == of and name in attrs:
                self._block[field] = attrs[name]

    def left(self, depth):
        if self._block is None:
            return
        if depth == self._heading:
            self._heading = -1
        if depth == self._bid:
            self._bid = -1
        if depth == self._depth:
            self._close()

    def _close(self):
        if not self._block.get("_promoted"):
            self.items.append({k: v for k, v in self._block.items() if k[0] != "_"})
        self._block = None

    def listens(self):
        return self._block is not None and self._bid >= 0

    def heard(self, text):
        self._block["bid"] += text

    def result(self) -> list[dict]:
        if self._block is not None:
            self._close()
        return [] if self.empty else self.items


def auction_items(html: str) -> list[dict]:
    """Raw items of one result page, as `parsers.html_items` gives them."""
    parser = _Products()
    parser.feed(html)
    return parser.result()


def auction_column(body: Column) -> Column:
    """`auction_items` as a column, for a profile's `parse`; NULL for a NULL page."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)

    items = pa.list_(pa.map_(pa.string(), pa.string()))

    @F.arrow_udf("array<map<string,string>>")
    def found(bodies: pa.Array) -> pa.Array:
        pages = (b.as_py() for b in bodies)
        return pa.array([None if p is None else [list(i.items()) for i in auction_items(p)] for p in pages], items)

    return found(body)


class _Links(_Walker):
    """Title and links of a page, skipping blocks of one class."""

    reads = None

    def __init__(self, skip_class: str | None) -> None:
        super().__init__()
        self.title = ""
        self.links: list[str] = []
        self._skip_class = skip_class
        self._skip = -1

    def entered(self, tag, attrs):
        if self._skip < 0 and self._skip_class in attrs.get("class", "").split():
            self._skip = len(self.open)
        if self._skip < 0 and tag == "a" and "href" in attrs:
            self.links.append(attrs["href"])

    def left(self, depth):
        if depth == self._skip:
            self._skip = -1

    def listens(self):
        return bool(self.open) and self.open[-1] == "title"

    def heard(self, text):
        self.title += text


def page_links(html: str) -> list[dict]:
    """One record per link of a page, in page order, with the page's title."""
    parser = _Links("ad")
    parser.feed(html)
    return [
        {"title": parser.title, "pos": pos, "href": href}
        for pos, href in enumerate(parser.links)
    ]


def extract(
    pages: DataFrame, key: str, html: str, parse: Callable[[str], list[dict]], fields: str
) -> DataFrame:
    """Rows `(key, *fields)` that `parse` finds in each page's `html` column.

    `parse` is the extension point for a new page layout: page text to records.
    """
    ship(pages.sparkSession)
    names = [f.strip().split()[0] for f in fields.split(",")]
    key_type = pages.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list[tuple] = []
            for k, body in zip(batch[key], batch[html]):
                if body is not None:
                    found += [(k, *[record.get(n) for n in names]) for record in parse(body)]
                if len(found) >= PIECE:
                    yield pd.DataFrame(found, columns=[key, *names])
                    found = []
            yield pd.DataFrame(found, columns=[key, *names])

    return pages.select(key, html).mapInPandas(rows, f"{key} {key_type}, {fields}")
