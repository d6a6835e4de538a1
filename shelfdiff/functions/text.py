"""Column functions on text: payload trimming, URLs, numbers, message parts."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

PART_LIMIT = 4096

# URL prefixes.
ITEM_URL = "https://jp.mercari.com/item/"
PHOTO_URL = "https://static.mercdn.net/item/detail/orig/photos/"

# Characters of a callback wrapper around a JSON body.
CALLBACK_HEAD = 9
CALLBACK_TAIL = 2

# Named character references with a semicolon, as HTML has them, by their names.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}


def strip_callback(body: Column) -> Column:
    """The JSON inside `callback(...);`."""
    inner = F.length(body) - (CALLBACK_HEAD + CALLBACK_TAIL)
    return F.substring(body, F.lit(CALLBACK_HEAD + 1), F.greatest(inner, F.lit(0)))


def page_count(body: Column) -> Column:
    """The digits after the first `"last_page":`, NULL without any."""
    digits = F.regexp_extract(body, r'"last_page":(\d+)', 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def item_url(item_id: Column) -> Column:
    return F.concat(F.lit(ITEM_URL), item_id)


def image_url(url: Column) -> Column:
    """The full-size photo behind a thumbnail: its file name under another folder."""
    return F.concat(F.lit(PHOTO_URL), F.substring_index(url, "/", -1))


def clear_query(url: Column) -> Column:
    """Drop `?query` and keep `#fragment`. Scheme case and an empty `#` stay as they are."""
    return F.regexp_replace(url, r"^([^?#]*)\?[^#]*", "$1")


# Digits that people type besides the ASCII ones.
FULL_WIDTH = "０１２３４５６７８９"


def _whole_number(text: Column) -> Column:
    plain = F.translate(text, FULL_WIDTH, "0123456789")
    return F.when(plain.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(plain).try_cast("int"))


def bid_number(text: Column) -> Column:
    """Bids from text such as `12x`: the last character counts as a unit.

    A bare `12` therefore gives 1, a single digit gives itself, anything else -1.
    """
    head = F.substring(text, F.lit(1), F.greatest(F.length(text) - 1, F.lit(0)))
    return F.coalesce(_whole_number(head), _whole_number(text), F.lit(-1))


def to_price(text: Column) -> Column:
    """Whole numbers only, `12.0` included. Empty, fractional or otherwise unreadable text is NULL and so
    never counts as a price drop; 0 stays a number.

    A store with loose column types would keep such text and order it above all numbers,
    reporting a drop where a price first becomes readable. That is not copied.
    """
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(?:\.0*)?\s*$", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def on_sale(status: Column) -> Column:
    return F.when(status == "on_sale", 1).otherwise(0)


def _character(code: Column) -> Column:
    """One character from its code point, NULL outside Unicode."""
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(utf32, "UTF-32"))


def unescape_html(text: Column) -> Column:
    """Decode all named and numeric character references, in one pass: what a reference
    stands for is never read as the start of another one. Unknown ones stay as they are.

    The text is cut at every `&`; each piece but the first begins with a reference, or
    with none.
    """
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
    pattern = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

    def meaning(name: Column) -> Column:
        hexadecimal = F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)
        decimal = F.substring(name, F.lit(2), F.length(name))
        code = F.when(name.rlike("^#[xX]"), hexadecimal).otherwise(decimal).try_cast("bigint")
        return F.when(F.substring(name, 1, 1) == "#", _character(code)).otherwise(names[name])

    def decode(piece: Column, name: Column) -> Column:
        known = F.when(name != "", meaning(name))
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        return F.coalesce(F.concat(known, rest), F.concat(F.lit("&"), piece))

    def piece_text(piece: Column, i: Column) -> Column:
        return F.when(i == 0, piece).otherwise(decode(piece, F.regexp_extract(piece, pattern, 1)))

    done = F.array_join(F.transform(F.split(text, "&"), piece_text), "")
    return F.when(F.contains(text, F.lit("&")), done).otherwise(text)


# Long texts are looked into block by block: finding character n of a text means walking
# there from its start.
BLOCK = 16_384

# A cut is one number: its start times this, plus its length.
CUT = 65_536


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def split_text(text: Column, limit: int = PART_LIMIT) -> Column:
    """Cut a text into parts of at most `limit` characters, array<string>.

    While more than `limit` characters are left, cut at the last newline among the first
    `limit` and drop that newline; without one, cut after `limit` characters.

    The fold takes one step per part, and its state is where the open part starts and the
    cuts so far, as numbers: Spark copies the state in every step. A part that ends at a newline leaves none in the
    rest of its window, so any two parts take more than `limit` characters together: twice
    the whole windows are steps enough.
    """
    if limit > BLOCK:
        raise ValueError(f"limit must not exceed {BLOCK}")

    def piece(blocks: Column, at: Column, size: Column) -> Column:
        """`size` characters from `at` on, out of at most two blocks."""
        block, offset = F.floor(at / BLOCK).cast("int"), at % BLOCK
        head = F.substring(F.get(blocks, block), offset + 1, size)
        over = F.greatest(offset + size - BLOCK, F.lit(0))
        tail = F.substring(F.coalesce(F.get(blocks, block + 1), F.lit("")), F.lit(1), over)
        return F.when(over > 0, F.concat(head, tail)).otherwise(head)

    def fold(whole: Column) -> Column:
        blocks, length = whole["blocks"], whole["length"]

        def cut(at: Column, size: Column) -> Column:
            return F.array(at.cast("bigint") * CUT + size)

        def taken(state: Column, back: Column) -> Column:
            """`back`: how far from the window's end its last newline is, 0 without one."""
            size = F.lit(limit) - back
            dropped = F.when(back > 0, 1).otherwise(0)
            return F.struct(
                (state["at"] + size + dropped).alias("at"),
                F.concat(state["cuts"], cut(state["at"], size)).alias("cuts"),
            )

        def step(state: Column, _: Column) -> Column:
            window = piece(blocks, state["at"], F.lit(limit))
            more = _bind(F.locate("\n", F.reverse(window)), lambda back: taken(state, back))
            return F.when(length - state["at"] > limit, more).otherwise(state)

        def finish(state: Column) -> Column:
            return F.concat(state["cuts"], cut(state["at"], length - state["at"]))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<bigint>").alias("cuts"))
        steps = F.sequence(F.lit(1), (2 * F.ceil(length / limit)).cast("int"))
        return F.transform(
            F.aggregate(steps, start, step, finish),
            lambda c: F.coalesce(piece(blocks, F.floor(c / CUT), c % CUT), F.lit("")),
        )

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))
    whole = F.struct(blocks.alias("blocks"), F.length(text).alias("length"))
    return F.when(F.length(text) <= limit, F.array(text)).otherwise(_bind(whole, fold))
