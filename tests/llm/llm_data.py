"""Small tables for the operators: words made up from a seed, with awkward rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = ["ka", "lo", "mi", "ne", "ru", "sta", "ve", "zu", "pin", "gor"]
# Columns whose names clash with those that operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "node long, component long, rank long, length long, digest string, score double, line long, part int"
)
EXTRA = (1, 2, 3, 4, "x", 0.5, 6, 7)


def word(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def sentence(r: random.Random, n: int) -> str:
    return " ".join(word(r) for _ in range(n))


def texts(seed: int = 1, n: int = 60) -> list[str]:
    r = random.Random(seed)
    return ["\n".join(sentence(r, r.randint(8, 40)) for _ in range(r.randint(1, 5))) for _ in range(n)]


def edited(text: str, seed: int, edits: int) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = word(r)
    return " ".join(words)


def rows() -> list[tuple]:
    """Plain texts, exact and near copies, and the awkward ones."""
    base = texts()
    out = [(i, t) for i, t in enumerate(base)]
    long = "\n".join(texts(9, 300))
    out += [(100, base[0]), (101, base[0]), (102, edited(base[1], 5, 1)), (103, None), (104, ""), (105, " \n\t ")]
    out += [(106, "one"), (107, "one"), (108, long), (109, edited(long, 3, 20)), (110, "Ünï côdé 中文 <|endoftext|>")]
    out += [(5, base[5]), (5, base[5])]
    named = [(i, t, "en" if i % 3 else None, f"s{i % 12}" if i % 7 else None, len(t or ""), *EXTRA) for i, t in out]
    return [*named, (None, base[7], "en", "s1", 1, *EXTRA), (None, None, None, None, None, *[None] * 8)]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
