"""Benchmark decontamination by pigeonhole edit matching on words.

A test item of m words may occur in a document with up to k word edits (`rate` of m). Cut
into k + 1 pieces, at least one piece of such an occurrence is untouched. So the first
`probe` words of every piece are looked up in every document by hash, and only where one
is found does Myers' bit-parallel distance decide, on the words around it.

Words are compared in lower case and without punctuation at their ends. The budget is
lowered where pieces would be shorter than a probe. Items go to the tasks in blocks of a
bounded number of words; every block meets every document, and nothing is shuffled.

Items of fewer than `min_words` words match only where all of their words stand unchanged:
the whole item is its probe.

Defined cases: null or empty texts match nothing, nor do items without a word; equal items
each report their matches; repeated documents each report theirs; empty tables give empty
results.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from shelfdiff.llm.words import WordHashes, keep_only, register, windows, word_hashes
from shelfdiff.session import ship

PROBE = 4
RATE = 0.2
MIN_WORDS = 8

# Items of one block, and their words on average: some MB of hashes.
BLOCK_ITEMS = 20_000
ITEM_WORDS = 50

# The first filter of probes, in bits of their hash.
FILTER_BITS = 20

MATCHES = (
    "doc_id long, item_id long, distance int, budget int, item_words int, start_word int, end_word int"
)


def _bare(word: bytes) -> bytes:
    return word.decode().lower().strip(string.punctuation).encode()


NORMAL = WordHashes(_bare)
register("decontaminate", NORMAL.clear)
_EMPTY = np.uint64(WordHashes()[b""])


def normal_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text; punctuation that stands alone is no word."""
    if not text:
        return np.empty(0, np.uint64)
    found = word_hashes(text.encode().split(), NORMAL)
    return found[found != _EMPTY]


def ends(pattern: dict[int, int], m: int, text: list[int], limit: int) -> tuple[int, int]:
    """(distance, end) of the best occurrence of a pattern in a text, the first of equals.

    `pattern` has the bit mask of the places of each word. Without an occurrence within
    `limit` edits the distance is `limit + 1`."""
    full = (1 << m) - 1
    top = 1 << (m - 1)
    up, down, score, best, at = full, 0, m, limit + 1, 0
    for i, word in enumerate(text):
        same = pattern.get(word, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        rise = down | (~(across | up) & full)
        fall = up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        up = fall | (~(vertical | rise) & full)
        down = rise & vertical
        if score < best:
            best, at = score, i + 1
    return best, at


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for i, word in enumerate(words):
        out[word] |= 1 << i
    return dict(out)


@dataclass
class Item:
    item_id: int
    words: list[int]
    budget: int

    def __post_init__(self):
        self.forward = _masks(self.words)
        self.backward = _masks(self.words[::-1])


class Block:
    """Compiled items and their probes, by length."""

    def __init__(self, rows: list[Row], rate: float, probe: int, min_words: int):
        self.items: list[Item] = []
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for row in rows:
            hashes = normal_hashes(row.text)
            m = len(hashes)
            if not m:
                continue
            if m < max(min_words, probe):
                found[m].append((int(windows(hashes, m)[0]), len(self.items), 0))
                self.items.append(Item(row.item_id, hashes.tolist(), 0))
                continue
            budget = min(int(rate * m), m // probe - 1)
            grams = windows(hashes, probe)
            for j in range(budget + 1):
                start = j * m // (budget + 1)
                found[probe].append((int(grams[start]), len(self.items), start))
            self.items.append(Item(row.item_id, hashes.tolist(), budget))
        self.probes = {size: Probes(rows) for size, rows in found.items()}

    def matches(self, text: str | None) -> list[tuple[int, int, int, int, int, int]]:
        """(item_id, distance, budget, item words, start, end) of every item in a text."""
        hashes = normal_hashes(text)
        starts: dict[int, set[int]] = defaultdict(set)
        for size, probes in self.probes.items():
            for item, start in probes.hits(windows(hashes, size)):
                starts[item].add(start)
        out = []
        for number, found in starts.items():
            item = self.items[number]
            m, k = len(item.words), item.budget
            best = (k + 1, 0, 0)
            for lo, hi in _joined([(s - k, s + m + k) for s in sorted(found)], len(hashes)):
                distance, end = ends(item.forward, m, words := hashes[lo:hi].tolist(), k)
                if distance < best[0]:
                    # Read backwards from its end, the same distance gives the start.
                    back = words[max(0, end - m - k) : end][::-1]
                    _, size = ends(item.backward, m, back, k)
                    best = (distance, lo + end - size, lo + end)
                    if not distance:
                        break
            if best[0] <= k:
                out.append((item.item_id, best[0], k, m, best[1], best[2]))
        return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0))


class Probes:
    """Hashes of probes of one length, in order, and of which item and place each is."""

    def __init__(self, found: list[tuple[int, int, int]]):
        found.sort()
        self.probes = np.array([x[0] for x in found], np.uint64)
        self.places = [x[1:] for x in found]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.probes & np.uint64((1 << FILTER_BITS) - 1)] = True

    def hits(self, grams: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place where it would start) for every probe found."""
        at = np.flatnonzero(self.filter[grams & np.uint64((1 << FILTER_BITS) - 1)])
        if not len(at):
            return
        first = np.searchsorted(self.probes, grams[at], "left")
        last = np.searchsorted(self.probes, grams[at], "right")
        for i, lo, hi in zip(at[last > first], first[last > first], last[last > first], strict=True):
            for item, start in self.places[lo:hi]:
                yield item, int(i) - start


def _joined(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Ascending spans cut to 0..size, overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in spans:
        lo, hi = max(lo, 0), min(hi, size)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _blocks(bench: DataFrame, item_id: str, text: str, size: int, **rules) -> Iterator[Block]:
    items = bench.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    items = items.filter("text is not null").distinct()
    words = F.sum(F.size(F.split(F.trim("text"), r"\s+")))
    total = items.agg(F.count(F.lit(1)).alias("items"), F.coalesce(words, F.lit(0)).alias("words")).first()
    n = max(-(-total["items"] // size), -(-total["words"] // (size * ITEM_WORDS)))
    for block in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield Block(part.collect(), **rules)


def find_matches(
    docs: DataFrame,
    bench: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    probe: int = PROBE,
    min_words: int = MIN_WORDS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """One row per document and item that it contains, with the best occurrence.

    `start_word` and `end_word` count the words of the document from 0, end excluded."""
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], MATCHES)
    rules = {"rate": rate, "probe": probe, "min_words": min_words}
    for compiled in _blocks(bench, item_id, item_text, block_items, **rules):
        block = spark.sparkContext.broadcast(compiled)

        def match(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            keep_only("decontaminate")
            for batch in batches:
                rows = [
                    (i, *found)
                    for i, t in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True)
                    for found in block.value.matches(t.as_py())
                ]
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
                names = [x.split()[0] for x in MATCHES.split(", ")]
                columns = zip(*rows, strict=True) if rows else [[]] * 7
                yield pa.record_batch(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
                )

        out = out.unionByName(plain.mapInArrow(match, MATCHES))
    return out


def remove_contaminated(
    docs: DataFrame,
    bench: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    probe: int = PROBE,
    min_words: int = MIN_WORDS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """`docs` without the rows whose text contains an item; all columns stay."""
    spark = docs.sparkSession
    ship(spark)
    rules = {"rate": rate, "probe": probe, "min_words": min_words}
    for compiled in _blocks(bench, item_id, item_text, block_items, **rules):
        block = spark.sparkContext.broadcast(compiled)

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            keep_only("decontaminate")
            for batch in batches:
                keep = [not block.value.matches(t.as_py()) for t in batch[text]]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
