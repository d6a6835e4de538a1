"""Two tokenizers side by side: which of their tokens cover the same bytes.

Rows are grouped by their full text, so that each distinct text is cut into tokens and
aligned once; its pairs of ids count as often as rows have it. Measures of distinct texts
are joined to the document ids.

The first tokenizer (A) reads a space and the text, the second (B) adds that space itself.
Byte offsets where tokens of both end cut the text into groups. The ends of all tokens cut
it into the overlaps of one A and one B token, called links. The count of a pair of ids is
the number of rows that hold it linked; a link is best if no pair of its A id has a higher
count.

Neither tokenizer has tokens across a single space or newline between other characters
(checked for the pieces of B; it is how A's pattern cuts). So texts are cut there, and a
worker aligns each distinct unit once as long as it is in its bounded cache. Counts come to
the texts in batches of texts (those of one task): each batch has the counts of just the
pairs in it, which arrive before the texts and are forgotten after them.

Defined cases: texts that are null, empty, or not given back byte by byte by both
tokenizers have no tokens: zeros and an empty hash. Repeated rows count as often as they
occur, a null document id is kept, an empty table gives an empty result. Strings of special
tokens are plain text. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm import words
from shelfdiff.session import settle, ship

CACHE_UNITS = 400_000
CHUNK_CHARACTERS = 1_000_000
HELD_PAIRS = 2_000_000

MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)")
# Units that keep their place among others, the space left out or with a newline.
_USUAL = re.compile(r"\n?\S(?:.*\S)?\Z", re.DOTALL)
_WORD = re.compile(r" \S+\Z")
_SPACES = (" ", "\n")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


class _Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the texts of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(path_a, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.cuttable = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # What follows an id: one of its own side, the other side, the next group, the next unit.
        a, b = len(self.bytes_a), len(self.bytes_b)
        self.texts = [f"{i}{end}" for n, end in ((a, ","), (a, "|"), (b, ","), (b, ";"), (b, "\n")) for i in range(n)]
        self.text_bases = np.cumsum([0, a, a, b, b])

    def encode_b(self, text: str) -> list[int]:
        """B's ids of a text that begins with the space that B adds, or with a newline."""
        if text.startswith(" "):
            return self.b.encode(text[1:], num_threads=1)
        return self.b.encode(text, num_threads=1)[1:]

    def cut(self, text: str) -> tuple[list[str], bool]:
        """The units of a text, and whether each is a word. The space before a unit is left
        out: a unit without a newline or space in front has one."""
        if not self.cuttable:
            return [" " + text], False
        units: list[str] = []
        for line in text.split("\n"):
            found = line.split()
            if not found or " ".join(found) != line:
                return [u[1:] if _WORD.match(u) else u for u in _CUTS.split(" " + text)], False
            if units:
                found[0] = "\n" + found[0]
            units += found
        return units, True


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order; sorting is quicker than `np.unique` on small arrays."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


class _Places(dict):
    """Numbers units in the order in which they first come; `new` gathers those that came last."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        return n


class Aligner:
    """Aligned units of this worker process: per unit its counts, the codes of its links
    and the text of its groups. Codes are A's id times 2^32 plus B's."""

    def __init__(self, path_a: str, path_b: str):
        self.of = _Tokenizers(path_a, path_b)
        self.clear()

    def clear(self) -> None:
        self.places = _Places()
        self.groups: list[str] = []
        self.bad: set[int] = set()  # units that are not given back byte by byte
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.starts = np.zeros(0, np.int64)  # of their codes
        self.codes = np.zeros(0, np.int64)

    def _add(self, units: list[str], words: bool) -> None:
        """Aligns units that have their places, the last ones; `words`: they all are words."""
        first = len(self.groups)
        usual = range(len(units)) if words else [i for i, u in enumerate(units) if _USUAL.match(u)]
        found = []
        if len(usual) and self.of.cuttable and (joint := self._aligned([units[i] for i in usual])):
            found.append((usual, joint))
            rest = sorted(set(range(len(units))).difference(usual))
        else:
            rest = range(len(units))
        found += [([i], self._aligned([units[i]])) for i in rest]
        self.groups += [""] * len(units)
        counts = np.zeros((len(units), 4), np.int64)
        starts = np.zeros(len(units), np.int64)
        codes, size = [self.codes], len(self.codes)
        for which, got in found:
            if got is None:  # not given back byte by byte
                self.bad.update(first + i for i in which)
                continue
            texts, numbers, links = got
            if len(which) == len(units):
                self.groups[first:] = texts
            else:
                for i, text in zip(which, texts, strict=True):
                    self.groups[first + i] = text
            counts[which] = numbers
            starts[which] = size + np.cumsum(numbers[:, 3]) - numbers[:, 3]
            codes.append(links)
            size += len(links)
        self.counts, self.codes = np.concatenate([self.counts, counts]), np.concatenate(codes)
        self.starts = np.concatenate([self.starts, starts])

    def _aligned(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray] | None:
        """Texts of groups, counts and codes of units that stand one after another."""
        of = self.of
        units = [u if u[:1] in _SPACES else " " + u for u in units]
        whole = "".join(units)
        data = whole.encode()
        a, b = of.a.encode_ordinary(whole), of.encode_b(whole)
        if b"".join(map(of.bytes_a.__getitem__, a)) != data or b"".join(map(of.bytes_b.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(of.lengths_a[a]), np.cumsum(of.lengths_b[b])
        unit_ends = np.cumsum([len(u) if u.isascii() else len(u.encode()) for u in units])
        # Bytes after which tokens end, and how many did before each.
        is_a, is_b = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        is_a[ends_a] = is_b[ends_b] = True
        any_end, both_end = is_a | is_b, is_a & is_b
        upto_a, upto_b, upto_group, upto = (np.cumsum(x, dtype=np.int32) for x in (is_a, is_b, both_end, any_end))
        ends = np.flatnonzero(any_end)
        codes = (a[upto_a[ends - 1]] << 32) | b[upto_b[ends - 1]]
        numbers = np.stack([x[unit_ends] for x in (upto_a, upto_b, upto_group, upto)], 1)
        numbers = np.diff(numbers, axis=0, prepend=0)
        # The text: in each group A's ids, then B's.
        of_a, of_b = upto_group[ends_a - 1], upto_group[ends_b - 1]
        n = int(upto_group[-1])
        n_a, n_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        place_a = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[of_a]
        place_b = np.arange(len(b)) + np.cumsum(n_a)[of_b]
        is_unit = np.zeros(len(data) + 1, bool)
        is_unit[unit_ends] = True
        last_a, last_b = is_b[ends_a], is_a[ends_b]
        kind_b = 2 + last_b + is_unit[ends_b]
        texts = np.empty(len(a) + len(b), np.int64)
        texts[place_a] = a + of.text_bases[last_a.astype(int)]
        texts[place_b] = b + of.text_bases[kind_b]
        return "".join(map(of.texts.__getitem__, texts.tolist())).split("\n")[:-1], numbers, codes

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The places of all units of the texts, and where each text's begin."""
        cut = [self.of.cut(t) for t in texts]
        if len(self.places) > CACHE_UNITS:
            self.clear()
        starts = np.cumsum([0, *(len(units) for units, _ in cut)])
        flat = chain.from_iterable(units for units, _ in cut)
        found = np.fromiter(map(self.places.__getitem__, flat), np.int64, starts[-1])
        if self.places.new:
            self._add(self.places.new, all(plain for _, plain in cut))
            self.places.new = []
        return found, starts

    def links(self, places: np.ndarray) -> np.ndarray:
        """The codes of the links of units, one after another."""
        sizes = self.counts[places, 3]
        lead = np.cumsum(sizes) - sizes
        return self.codes[np.arange(sizes.sum()) + np.repeat(self.starts[places] - lead, sizes)]

    def whole(self, places: np.ndarray) -> bool:
        return not self.bad or self.bad.isdisjoint(places.tolist())


_ALIGNERS: dict[tuple[str, str], Aligner] = {}
words.register("alignment", lambda: [a.clear() for a in _ALIGNERS.values()])


def aligner(paths: tuple[str, str]) -> Aligner:
    words.keep_only("alignment")
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


def _chunks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch, some at a time, and the place of the first."""
    held: list[str] = []
    size, first = 0, 0
    for i, value in enumerate(batch[text]):
        held.append(value.as_py())
        size += len(held[-1])
        if size > CHUNK_CHARACTERS:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _summed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order and the sums of their weights."""
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(weights, first) if len(first) else weights


HELD = "bucket int, code long, held long"


def _held_pairs(texts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """In how many rows of each bucket a pair of ids is linked; sums may come in parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(paths)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, bucket = 0, None

        def flush() -> pa.RecordBatch:
            codes, sums = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            of = pa.array(np.full(len(codes), bucket, np.int32))
            return pa.record_batch([of, pa.array(codes), pa.array(sums)], ["bucket", "code", "held"])

        for batch in batches:
            buckets, n_rows = batch["bucket"].to_numpy(), batch["n_rows"].to_numpy()
            for first, chunk in _chunks(batch, "text"):
                places, starts = own.units(chunk)
                for i in range(len(chunk)):
                    if held and (buckets[first + i] != bucket or size > HELD_PAIRS):
                        yield flush()
                        held, size = [], 0
                    bucket = buckets[first + i]
                    units = _distinct(places[starts[i] : starts[i + 1]])
                    if own.whole(units):
                        codes = _distinct(own.links(units))
                        held.append((codes, np.full(len(codes), n_rows[first + i])))
                        size += len(codes)
                        if size > HELD_PAIRS:
                            held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                            size = len(held[0][0])
        if held:
            yield flush()

    return texts.mapInArrow(count, HELD)


def _measures(texts: DataFrame, pairs: DataFrame, n: int, paths: tuple[str, str]) -> DataFrame:
    """key and the measures of every text. `pairs` has for each bucket the pairs of its
    texts: their counts, negative where no pair of the A id has a higher one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(paths)
        number = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        codes = counts = np.zeros(0, np.int64)
        for batch in batches:
            buckets, is_text = batch["bucket"].to_numpy(), batch["is_text"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(buckets) != 0) | (np.diff(is_text.astype(int)) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(buckets)], strict=True):
                if lo == hi:
                    continue
                if number != buckets[lo]:
                    held, codes, number = [], np.zeros(0, np.int64), buckets[lo]
                part = batch.slice(lo, hi - lo)
                if not is_text[lo]:
                    held.append((part["code"].to_numpy(), part["count"].to_numpy()))
                    continue
                if held:
                    codes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
                    order = np.argsort(codes)
                    codes, counts, held = codes[order], counts[order], []
                for first, chunk in _chunks(part, "text"):
                    rows = _measured(own, chunk, codes, counts)
                    keys = part["key"].slice(first, len(chunk))
                    yield pa.RecordBatch.from_arrays([keys, *rows], ["key", *[x.split()[0] for x in MEASURES.split(", ")]])

    both = pairs.select(
        "bucket", F.lit(False).alias("is_text"), "code", "count", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("string").alias("text")
    ).unionByName(
        texts.select(
            "bucket", F.lit(True).alias("is_text"), F.lit(None).cast("long").alias("code"), F.lit(None).cast("long").alias("count"), "key", "text"
        )
    )
    ordered = both.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "is_text")
    return ordered.mapInArrow(work, f"key binary, {MEASURES}")


def _measured(own: Aligner, chunk: list[str], codes: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    places, starts = own.units(chunk)
    # Sums over the links of each unit of this chunk, once.
    used = np.zeros(len(own.counts), bool)
    used[places] = True
    distinct = np.flatnonzero(used)
    nth = (np.cumsum(used) - 1)[places]
    sizes = own.counts[distinct, 3]
    of_unit = np.repeat(np.arange(len(distinct)), sizes)
    links = own.links(distinct)
    if len(codes):
        at = np.minimum(np.searchsorted(codes, links), len(codes) - 1)
        found = np.where(codes[at] == links, counts[at], 0)
    else:
        found = np.zeros(len(links), np.int64)
    best = np.bincount(of_unit[found < 0], minlength=len(distinct))
    ends = np.cumsum(sizes)
    sums_to = np.append(0, np.cumsum(np.abs(found)))
    sums = sums_to[ends] - sums_to[ends - sizes]
    per_unit = np.column_stack([own.counts[distinct], best, sums])
    rows, texts = np.zeros((len(chunk), 6), np.int64), []
    # Sums over each text's units; texts have at least one.
    by_text = np.add.reduceat(per_unit[nth], starts[:-1])
    names = list(map(own.groups.__getitem__, places.tolist()))
    for i in range(len(chunk)):
        lo, hi = starts[i], starts[i + 1]
        if not own.whole(places[lo:hi]):
            texts.append("")
            continue
        rows[i] = by_text[i]
        texts.append(hashlib.sha256(";".join(names[lo:hi]).encode()).hexdigest())
    return [*(pa.array(rows[:, k].copy()) for k in range(6)), pa.array(texts, pa.string())]


def align(
    docs: DataFrame,
    paths: tuple[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark = docs.sparkSession
    ship(spark)
    paths = paths or default_paths()
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    there = F.col("text").isNotNull() & (F.col("text") != "")
    # A key for the way back to the document ids; texts themselves meet in full.
    key = F.unhex(F.sha2("text", 256)).alias("key")
    texts = plain.filter(there).groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"))
    texts = settle(texts.select(key, "text", "n_rows", F.spark_partition_id().alias("bucket")), "align-texts")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    held = _held_pairs(texts.select("bucket", "text", "n_rows"), paths)
    held = settle(held.groupBy("bucket", "code").agg(F.sum("held").alias("held")), "align-pairs")
    counts = held.groupBy("code").agg(F.sum("held").alias("count"))
    id_a = F.shiftright("code", 32)
    best = counts.groupBy(id_a.alias("a")).agg(F.max("count").alias("most"))
    marked = counts.withColumn("a", id_a).join(best, "a")
    marked = marked.select("code", F.when(F.col("count") == F.col("most"), -F.col("count")).otherwise(F.col("count")).alias("count"))
    pairs = held.select("bucket", "code").join(marked, "code")

    measured = settle(_measures(texts, pairs, n, paths), "align-measures")
    names = [x.split()[0] for x in MEASURES.split(", ")]
    rows = plain.select("doc_id", F.when(there, key).alias("key"))
    # Rows without text have no key: they stay out of the shuffle.
    with_text = rows.filter("key is not null").join(measured, "key").select("doc_id", *names)
    zeros = [F.lit(0).cast("long").alias(x) for x in names[:-1]]
    without = rows.filter("key is null").select("doc_id", *zeros, F.lit("").alias("groups_sha256"))
    return with_text.unionByName(without)
