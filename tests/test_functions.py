import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from shelfdiff.functions import text as tx
from shelfdiff.functions import times as tm


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


CASES = {
    "to_price": (
        tx.to_price,
        {"1200": 1200, "": None, "1,200": None, None: None, "007": 7, "12.5": None, "12.0": 12,
         " 5 ": 5, "0": 0, "-3": -3, "99999999999999999999": None},
    ),
    "bid_number": (
        tx.bid_number,
        {"12x": 12, "5": 5, "12": 1, "-": -1, "": -1, "1.9": -1, None: -1, "+3x": 3, " 7 ": 7,
         "12件": 12, "１２x": 12},
    ),
    "clear_query": (
        tx.clear_query,
        {"http://h/a?x=1&y#f": "http://h/a#f", "http://h/a#f?x": "http://h/a#f?x",
         "http://h/a?": "http://h/a", "http://h/a": "http://h/a", "?": ""},
    ),
    "strip_callback": (
        tx.strip_callback,
        {'callback({"a":1});': '{"a":1}', "callback();": "", "call": "", "": ""},
    ),
    "page_count": (
        tx.page_count,
        {'{"last_page":37,"last_page":2}': 37, "{}": None, '"last_page": 3': None},
    ),
    "image_url": (tx.image_url, {"https://t/a/b.jpg": tx.PHOTO_URL + "b.jpg", "b.jpg": tx.PHOTO_URL + "b.jpg"}),
    "item_url": (tx.item_url, {"m1": "https://jp.mercari.com/item/m1"}),
    "on_sale": (tx.on_sale, {"on_sale": 1, "trading": 0, None: 0}),
    "unescape": (
        tx.unescape_html,
        {"a &amp; b": "a & b", "&amp;lt;": "&lt;", "&#12354;&#x1F600;": "あ\U0001f600", "&lt;&gt;&quot;&#39;": "<>\"'",
         "&#38;amp;": "&amp;", "&yen;&hearts;&copy": "¥♥&copy", "&nope; &;&&amp;": "&nope; &;&&", "&": "&",
         "&#0;": "&#0;", "plain": "plain", "&nbsp;": " ", None: None},
    ),
    "end_time": (
        tm.end_time,
        {"1650000000.5": datetime(2022, 4, 15, 5, 20, 0, 500000), "soon": None, "": None},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_scalar(spark, name):
    function, cases = CASES[name]
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_local_time(spark):
    ts = datetime(2022, 4, 15, 5, 20, 0, 700000)
    assert apply(spark, tm.local_time, [ts], "timestamp") == ["2022-04-15 14:20:00+09:00"]
    west = apply(spark, lambda c: tm.local_time(c, "America/St_Johns"), [ts], "timestamp")
    assert west == ["2022-04-15 02:50:00-02:30"]


def cut(text: str, limit: int) -> list[str]:
    """While too long: cut at the last newline of the first `limit`, else after them."""
    out = []
    while len(text) > limit:
        head = text[:limit]
        if "\n" in head:
            at = head.rindex("\n")
            out.append(text[:at])
            text = text[at + 1 :]
        else:
            out.append(head)
            text = text[limit:]
    return [*out, text]


def test_split_text(spark):
    rnd = random.Random(0)
    texts = []
    for _ in range(2000):
        p = rnd.choice([0, 0.02, 0.1, 0.5, 0.95])
        n = rnd.randint(0, 60)
        texts.append("".join("\n" if rnd.random() < p else rnd.choice("abé日😀") for _ in range(n)))
    for limit in (1, 7, 16):
        got = apply(spark, lambda c, n=limit: tx.split_text(c, n), texts)
        assert got == [cut(t, limit) for t in texts]


def test_split_text_at_the_limit(spark):
    texts = ["x" * 4096, "x" * 4097, "x" * 4095 + "\n" + "y", "x" * 9000, "\n" * 5000, None]
    got = apply(spark, tx.split_text, texts)
    assert got == [cut(t, 4096) if t is not None else None for t in texts]


def test_split_text_across_blocks(spark):
    rnd = random.Random(1)
    texts = [
        "".join(rnd.choice("aé日😀") + ("\n" if rnd.random() < p else "") for _ in range(n))
        for p, n in ((0.01, 150_000), (0.0001, 200_000), (0, 140_000))
    ]
    texts.append("x" * tx.BLOCK + "\n" + "y" * tx.BLOCK + "\n")
    assert apply(spark, tx.split_text, texts) == [cut(t, 4096) for t in texts]
    assert apply(spark, lambda c: tx.split_text(c, 16_000), texts) == [cut(t, 16_000) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab\n ", max_size=30), min_size=1, max_size=40))
def test_split_text_loses_nothing(spark, texts):
    for text, parts in zip(texts, apply(spark, lambda c: tx.split_text(c, 5), texts)):
        assert parts == cut(text, 5)


