"""Main text of web pages by paths that the pages of a host agree on.

Each page's containers are scored by the share of its running text they hold, links
counting against them. A container is named by its generalised path: the tags from the
root, each with its classes, digits replaced. Scores are added up by host and path in
Spark; the best path of a host wins. Then every page is read again and the elements at
its host's path give the text, without what lies in menus, headers, footers, forms,
adverts and the like inside them. What is such only by its class or id is kept where the
article lies in it. A page that has no such element falls back on its own
best container.

Defined cases: null or empty html gives an empty text; a url without a host, or null,
belongs to one nameless host; broken markup is read as far as it goes (elements end where
an outer one ends, or the page does); repeated rows vote twice and give equal texts; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.spark_tools import few
from shelfdiff.session import settle, ship

# HTML's elements without content, with raw text, and within lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt
    ruby s samp small span strike strong sub sup time tt u var wbr br img""".split()
)
# Elements that end an open paragraph, or an open one of their own kind.
ENDS_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section
    summary table ul""".split()
)
SIBLINGS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SIBLING_BARRIER = frozenset("ul ol dl table article section div main body".split())
CONTAINERS = frozenset("body main article section div td center table tbody tr fieldset blockquote".split())

# Elements, roles and words of class names and ids that mark what is not the article.
ASIDE_TAGS = frozenset("nav footer aside form button dialog menu fieldset search input".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split()
)
ASIDE_WORDS = frozenset(
    """nav navbar navigation menu menus topbar header masthead footer foot sidebar aside ad ads advert
    adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    share sharing social related recommended recommendations comment comments commentlist disqus replies
    reply breadcrumb breadcrumbs pagination pager widget widgets toolbar skip copyright legal disclaimer
    hidden""".split()
)
HEADER_WORDS = frozenset(["header"])
# What such a word follows in a class name is said of something else: has-sidebar.
MODIFIERS = frozenset("has have with no not without".split())
# Words that may also name a section of an article, which then has running text.
TOPIC_WORDS = frozenset("related social legal notice notices alert copyright disclaimer share sharing reply replies".split())
SECTION_CHARS = 100
# Of the running text, so much lies outside of what is aside by name.
OUTSIDE = 0.05

# Raw text elsewhere, but text of an article inside one; and elements within
# lines of formulas and drawings.
ARTICLE_TEXT = frozenset("math svg object noscript".split())
PHRASING = INLINE | frozenset(
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder semantics annotation text tspan".split()
)

DEEPEST = 64

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    path: str
    parent: int
    aside: bool
    in_article: bool
    in_link: bool = False
    named: str = ""
    depth: int = 0
    text: int = 0
    linked: int = 0


@dataclass
class Page:
    """Elements of a page, and its text in order: (element, text), or None where a block
    begins or ends."""

    elements: list[Element] = field(default_factory=list)
    runs: list[tuple[int, str] | None] = field(default_factory=list)


def _marks_aside(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in ASIDE_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in ASIDE_ROLES or attributes.get("aria-hidden") == "true":
        return True
    if "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")):
        return True
    return False


def _named(tag: str, attributes: dict[str, str], in_article: bool) -> str:
    """Whether class names and id speak of what is not the article: "aside", "topic" if
    they may also name a section of one, or nothing."""
    if not attributes or tag in ("body", "html", "main"):
        return ""
    if tag == "article" and not attributes.get("class", "").strip():
        return ""
    found = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        for word in map(str.lower, _WORDS.findall(name)):
            if word in MODIFIERS:
                break
            found.add(word)
    found &= ASIDE_WORDS
    if in_article:
        found -= HEADER_WORDS
    if not found:
        return ""
    return "topic" if in_article and found <= TOPIC_WORDS else "aside"


def _settle_named(page: Page) -> None:
    """Elements are aside by name unless the article lies in them: an article or main that
    has more running text than all of the page outside of named elements, or, where next
    to nothing is outside, the most of the page's text."""
    elements = page.elements
    if not any(e.named for e in elements):
        return
    n = len(elements)
    own, linked = [0] * n, [0] * n
    for run in page.runs:
        if run is not None and not elements[run[0]].aside:
            size = len(run[1].strip())
            if elements[run[0]].in_link:
                linked[run[0]] += size
            else:
                own[run[0]] += size
    held = own[:]
    for i in range(n - 1, 0, -1):
        held[elements[i].parent] += held[i]
        linked[elements[i].parent] += linked[i]
    for i, e in enumerate(elements):
        if e.named == "topic" and held[i] >= SECTION_CHARS and held[i] > linked[i]:
            e.named = ""
    outer = _outermost(elements)
    while any(outer):
        outside = sum(size for size, top in zip(own, outer, strict=True) if not top)
        articles = [i for i, e in enumerate(elements) if e.tag in ("article", "main") and held[i] and not e.aside]
        if any(not outer[i] for i in articles):
            break
        articles = [i for i in articles if not elements[i].named and held[i] > outside]
        if articles:
            found = max(articles, key=lambda i: held[i])
        else:
            found = max((i for i in range(1, n) if outer[i] == i), key=lambda i: held[i])
            if not held[found] or outside >= OUTSIDE * held[0]:
                break
        elements[outer[found]].named = ""
        outer = _outermost(elements)
    for e, top in zip(elements, outer, strict=True):
        e.aside = e.aside or top > 0


def _outermost(elements: list[Element]) -> list[int]:
    """Of each element the outermost named one that holds it, or that it is; else 0."""
    out = [0] * len(elements)
    for i, e in enumerate(elements):
        if e.parent >= 0:
            out[i] = out[e.parent] or (i if e.named else 0)
    return out


def _label(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(re.sub(r"\d+", "0", attributes.get("class", "")).split()))
    return ".".join([tag, *classes])


def parse(source: str) -> Page:
    """Reads a page leniently, in one pass over its tags."""
    page = Page([Element("", "", -1, False, False)])
    elements, runs = page.elements, page.runs
    stack = [0]
    at, size = 0, len(source)
    while at < size:
        found = _MARKUP.search(source, at)
        end = found.start() if found else size
        if end > at:
            piece = source[at:end]
            if not piece.isspace():
                runs.append((stack[-1], piece))
            elif runs and runs[-1] is not None:
                runs.append((stack[-1], " "))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag not in PHRASING:
            runs.append(None)
        elif tag == "br":
            runs.append((stack[-1], " "))
        if found[1]:
            _close(elements, stack, tag)
            continue
        attributes = {}
        if found[3].strip(" /\n\t\r"):
            attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(found[3])}
        if tag in RAW and not (tag in ARTICLE_TEXT and elements[stack[-1]].in_article):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = close.end() if close else size
            continue
        if tag in ENDS_P:
            _end(elements, stack, frozenset("p"), frozenset())
        if tag in SIBLINGS:
            _end(elements, stack, SIBLINGS[tag], SIBLING_BARRIER - {tag})
        if tag in VOID:
            continue
        above = elements[stack[-1]]
        in_article = above.in_article or tag in ("article", "main")
        aside = above.aside or _marks_aside(tag, attributes, in_article)
        in_link = above.in_link or tag == "a"
        # Beyond some depth elements share their parent's path: paths stay short.
        path = f"{above.path}>{_label(tag, attributes)}" if above.depth < DEEPEST else above.path
        elements.append(Element(tag, path, stack[-1], aside, in_article, in_link, _named(tag, attributes, in_article), above.depth + 1))
        stack.append(len(elements) - 1)
    _settle_named(page)
    return page


def _close(elements: list[Element], stack: list[int], tag: str) -> None:
    """An end tag closes up to its element; one within a line doesn't close blocks."""
    for i in range(len(stack) - 1, 0, -1):
        open_tag = elements[stack[i]].tag
        if open_tag == tag:
            del stack[i:]
            return
        if tag in INLINE and open_tag not in INLINE:
            return


def _end(elements: list[Element], stack: list[int], tags: frozenset[str], barrier: frozenset[str]) -> None:
    """Closes the nearest open element among `tags`, if no barrier stands before it. For
    paragraphs, any block does."""
    for i in range(len(stack) - 1, 0, -1):
        tag = elements[stack[i]].tag
        if tag in tags:
            del stack[i:]
            return
        if tag in barrier or (not barrier and tag not in INLINE):
            return


def scores(page: Page) -> dict[str, float]:
    """The score of each path of a container that holds text, from the share it holds."""
    elements = page.elements
    for element in elements:
        element.text = element.linked = 0
    for run in page.runs:
        if run is None or elements[run[0]].aside:
            continue
        element, n = elements[run[0]], len(run[1].strip())
        element.text += n
        element.linked += n if element.in_link else 0
    # Parents come before their children.
    for element in reversed(elements[1:]):
        elements[element.parent].text += element.text
        elements[element.parent].linked += element.linked
    total = elements[0].text
    if not total:
        return {}
    out: dict[str, float] = {}
    for element in elements:
        # Text may also lie outside of any container: the page itself is one.
        if element.tag and element.tag not in CONTAINERS or element.aside or not element.text:
            continue
        share = (element.text - element.linked) / total
        bonus = 0.2 if element.tag in ("article", "main") else 0.0
        # Inside an article, parts of it shouldn't win over the whole.
        inner = 0.1 if element.in_article and not bonus else 0.0
        out[element.path] = max(out.get(element.path, 0.0), share * (1 + bonus + 0.01 * min(element.depth, DEEPEST) - inner))
    return out


def extract(page: Page, path: str | None) -> str:
    """The text of the elements at `path`, or of the best container without such."""
    elements = page.elements
    roots = {i for i, e in enumerate(elements) if e.path == path and not e.aside}
    if not roots:
        ranked = scores(page)
        if ranked:
            best = max(ranked, key=lambda p: (ranked[p], p))
            roots = {i for i, e in enumerate(elements) if e.path == best and not e.aside}
        else:
            roots = {0}
    inside = [False] * len(elements)
    for i, element in enumerate(elements):
        inside[i] = (i in roots or (element.parent >= 0 and inside[element.parent])) and not element.aside
    blocks: list[str] = []
    block: list[str] = []
    for run in [*page.runs, None]:
        if run is None:
            text = " ".join("".join(block).split())
            if text:
                blocks.append(text)
            block = []
        elif inside[run[0]]:
            block.append(entities.unescape(run[1]))
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host and path: of each host the path with the highest sum of scores."""
    ship(pages.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], float] = {}
            for host, source in zip(batch["host"].to_pylist(), batch["html"], strict=True):
                for path, score in scores(parse(source.as_py() or "")).items():
                    sums[host, path] = sums.get((host, path), 0.0) + score
            hosts, paths = [h for h, _ in sums], [p for _, p in sums]
            yield pa.record_batch(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(list(sums.values()), pa.float64())],
                ["host", "path", "score"],
            )

    plain = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    votes = plain.mapInArrow(vote, "host string, path string, score double")
    # Rounded, so that the order of additions can't change a winner.
    sums = votes.groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"))
    best = sums.groupBy("host").agg(F.max(F.struct("score", "path")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"))


TEXTS = "page_id long, url string, text string, n_chars long"


def main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""
    winners = few(settle(winning_paths(pages, url, html), "paths"))
    plain = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    joined = plain.join(winners, "host", "left").select("page_id", "url", "html", "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                extract(parse(source.as_py()), path) if source.is_valid else ""
                for source, path in zip(batch["html"], batch["path"].to_pylist(), strict=True)
            ]
            sizes = pa.array(map(len, texts), pa.int64())
            yield pa.record_batch(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), sizes],
                [x.split()[0] for x in TEXTS.split(", ")],
            )

    return joined.mapInArrow(read, TEXTS)
