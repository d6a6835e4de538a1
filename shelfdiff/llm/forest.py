"""Near-duplicate documents by an LSH forest.

A document's set are its distinct five-word shingles (`words.shingles`). Documents with
equal sets form a class; one of each class goes on. Its MinHash values are dealt to
`TREES` trees of `DEPTH` values each, and every tree sorts all documents by its values.
Documents with a common prefix of `LEAST_DEPTH` values are neighbours in that order and
make a region. A region of a few documents has all its pairs looked at. A larger one is
looked at deeper: it is split by its next value, again and again, until its parts are
small; and at every step all its documents are compared with its hub, the document whose
values agree best with the most common ones, so that a large group of copies hangs
together however it is split. As soon as such a part has no more than `WHOLE` documents,
those that are not clearly the hub's are held against all of it, and each pairs up with
its `BEST` best. That is a first look: a region whose documents are not all one component
after it is compared in full, block against block (`dense`).

Looking at a pair means comparing the low bytes of all its MinHash values; pairs that may
reach the similarity are then confirmed on full sets. Within a region, pairs that are
linked already by way of clearly similar ones are left out: they add nothing to
components.

The sorted order is cut into ranges for the tasks, wherever that falls; regions on both
sides of a cut have their hubs compared, and are compared in full in the same way.

At a similarity of 0.75 a pair shares a prefix in some tree with probability 0.99995.

Defined cases: null and empty texts have empty sets and are linked with nothing; repeated
rows each get their row; of different texts under one id, one set (the least in byte
order) counts for links; a null id is linked with nothing; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm import dense, words
from shelfdiff.llm.components import components
from shelfdiff.llm.spark_tools import few
from shelfdiff.session import settle, ship

TREES = 12
DEPTH = 8
LEAST_DEPTH = 2
VALUES = TREES * DEPTH
SMALL = 32
PERCENT = 75

# Of 96 values, a pair of similarity 0.75 agrees in 72 with a deviation of 4.2: it has
# fewer than 53 about once in 300,000 times. From 87 on, a pair of less is as rare.
MAYBE = 53
SURELY = 87

WHOLE = 4096
BEST = 3
ROWS_PER_TASK = 40_000

_RANDOM = np.random.default_rng(75)
_XOR = _RANDOM.integers(0, 2**32, VALUES, dtype=np.uint32)
_FACTOR = _RANDOM.integers(0, 2**31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set that is not empty."""
    low = shingles.astype(np.uint32)
    out = np.full(VALUES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(low), 2048):
        np.minimum(out, ((low[i : i + 2048, None] ^ _XOR) * _FACTOR).min(0), out=out)
    return out


SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The size, a 128-bit digest and the MinHash values of each document's set; the last
    two are null for empty sets."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in SIGNED.split(", ")]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("words")
        for batch in batches:
            sizes, digests, values = [], [], []
            for t in batch["text"]:
                found = words.shingles(words.word_hashes(words.lower_words(t.as_py())))
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                values.append(min_hashes(found).tobytes() if len(found) else None)
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(values, pa.binary())]
            yield pa.record_batch(columns, names)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(sign, SIGNED)


class _Sorted:
    """The rows of one task: documents in the order of (tree, values)."""

    def __init__(self, trees: np.ndarray, values: np.ndarray, ids: np.ndarray, marks: np.ndarray):
        self.ids, self.marks = ids, marks
        self.pairs: list[tuple[int, int]] = []
        same = (values[1:] == values[:-1]) & (trees[1:] == trees[:-1])[:, None]
        #: how many leading values a row shares with the row before
        self.common = np.concatenate([[0], np.cumprod(same, axis=1).sum(1)]) if len(ids) else np.zeros(0, int)

    def cuts(self, lo: int, hi: int, depth: int) -> np.ndarray:
        """Bounds of the parts of rows lo..hi that share `depth` values."""
        return np.concatenate([[lo], np.flatnonzero(self.common[lo + 1 : hi] < depth) + lo + 1, [hi]])

    def hub(self, lo: int, hi: int) -> int:
        """The row that agrees with the most common bytes in most places."""
        marks = self.marks[lo:hi]
        counts = np.zeros(VALUES * 256, np.int64)
        for i in range(0, len(marks), 8192):
            some = marks[i : i + 8192].astype(np.int64) + np.arange(VALUES) * 256
            counts += np.bincount(some.ravel(), minlength=VALUES * 256)
        usual = counts.reshape(VALUES, 256).argmax(1).astype(np.uint8)
        agree = (marks == usual).sum(1)
        best = np.flatnonzero(agree == agree.max())
        return lo + int(best[np.argmin(self.ids[lo:hi][best])])

    def add(self, a: int, b: int) -> None:
        self.pairs.append((int(self.ids[a]), int(self.ids[b])))

    def all_pairs(self, rows: np.ndarray, tied: np.ndarray) -> None:
        """Pairs among a few rows; those tied to the same hub hang together already."""
        marks = self.marks[rows]
        agree = (marks[:, None, :] == marks[None, :, :]).sum(2)
        group = np.arange(len(rows))
        for hub in np.unique(tied[tied >= 0]):
            group[tied == hub] = group[tied == hub].min()
        upper_a, upper_b = np.triu_indices(len(rows), 1)
        score = agree[upper_a, upper_b]
        order = np.argsort(-score, kind="stable")
        for k in order[: int((score >= SURELY).sum())]:
            a, b = upper_a[k], upper_b[k]
            if group[a] != group[b]:
                self.add(rows[a], rows[b])
                group[group == group[b]] = group[a]
        maybe = (score >= MAYBE) & (score < SURELY) & (group[upper_a] != group[upper_b])
        for a, b in zip(upper_a[maybe], upper_b[maybe], strict=True):
            self.add(rows[a], rows[b])

    def best_few(self, lo: int, hi: int, rows: np.ndarray) -> None:
        """Pairs of `rows` with their best few in lo..hi, as far as these may be similar."""
        marks = self.marks[lo:hi]
        for i in range(0, len(rows), 64):
            some = rows[i : i + 64]
            agree = (self.marks[some][:, None, :] == marks[None, :, :]).sum(2, dtype=np.int16)
            agree[np.arange(len(some)), some - lo] = -1
            for best in np.argpartition(-agree, BEST, axis=1)[:, :BEST].T:
                good = agree[np.arange(len(some)), best] >= MAYBE
                for a, b in zip(some[good], best[good] + lo, strict=True):
                    self.add(a, b)

    def look(self, lo: int, hi: int, depth: int, tied: np.ndarray, whole: bool = False) -> None:
        """Pairs of the region lo..hi, whose rows share `depth` values. `tied` has for each
        row the hub that it clearly belongs to, by way of other hubs too, or -1; `whole`
        marks a region that lies within one whose rows were held against each other."""
        while hi - lo > SMALL:
            hub = self.hub(lo, hi)
            agree = (self.marks[lo:hi] == self.marks[hub]).sum(1)
            alone = tied < 0
            for row in np.flatnonzero(alone & (agree >= MAYBE)) + lo:
                if row != hub:
                    self.add(row, hub)
            mine = tied[hub - lo] if tied[hub - lo] >= 0 else hub
            tied = np.where(alone & (agree >= SURELY), mine, tied)
            if (tied == mine).all():
                return
            if hi - lo <= WHOLE and not whole:
                self.best_few(lo, hi, np.flatnonzero(tied < 0) + lo)
                whole = True
            if depth == DEPTH:
                for i in range(lo, hi, SMALL):
                    self.all_pairs(np.arange(i, min(i + SMALL, hi)), tied[i - lo : i - lo + SMALL])
                return
            depth += 1
            bounds = self.cuts(lo, hi, depth)
            sizes = np.diff(bounds)
            if len(sizes) == 1:
                continue
            for a, b in zip(bounds[:-1][sizes > 1], bounds[1:][sizes > 1], strict=True):
                part = tied[a - lo : b - lo]
                if (part < 0).any() or (part != part[0]).any():
                    self.look(int(a), int(b), depth, part, whole)
            return
        if hi - lo > 1:
            self.all_pairs(np.arange(lo, hi), tied)

    def run(self) -> list[tuple[int, int]]:
        bounds = self.cuts(0, len(self.ids), LEAST_DEPTH)
        sizes = np.diff(bounds)
        # Most regions have two documents: these are looked at together.
        two = bounds[:-1][sizes == 2]
        agree = (self.marks[two] == self.marks[two + 1]).sum(1)
        for row in two[agree >= MAYBE]:
            self.add(row, row + 1)
        for a, b in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2], strict=True):
            self.look(int(a), int(b), LEAST_DEPTH, np.full(b - a, -1))
        return sorted({(min(p), max(p)) for p in self.pairs})


def first_look(rows: DataFrame, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) from the regions of sorted rows: tree, key (the bytes of
    `DEPTH` 32-bit values), doc_id and marks (the low bytes of all MinHash values); and
    the regions that a cut may run through (region: the tree and its first values)."""
    spark = rows.sparkSession

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range holds about ROWS_PER_TASK rows of some 150 bytes.
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        if not table.num_rows:
            return
        trees, ids = table["tree"].to_numpy(), table["doc_id"].to_numpy()
        keys, marks = _matrix(table["key"], 4 * DEPTH), _matrix(table["marks"], VALUES)
        task = _Sorted(trees, keys.view("<u4"), ids, marks)
        pairs = [(a, b, None) for a, b in task.run()]
        bounds = task.cuts(0, len(ids), LEAST_DEPTH)
        for lo, hi in {(int(bounds[0]), int(bounds[1])), (int(bounds[-2]), int(bounds[-1]))}:
            key = bytes([int(trees[lo])]) + keys[lo, : 4 * LEAST_DEPTH].tobytes()
            pairs.append((int(ids[task.hub(lo, hi)]), None, key))
        columns = zip(*pairs, strict=True)
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "edge"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(n, -(-n_rows // ROWS_PER_TASK))
    rows = rows.withColumn("salt", F.xxhash64("doc_id"))
    ordered = rows.repartitionByRange(tasks, "tree", "key", "salt").sortWithinPartitions("tree", "key", "salt")
    ordered = ordered.select("tree", "key", "doc_id", "marks")
    found = settle(ordered.mapInArrow(neighbours, "a long, b long, edge binary"), "neighbours")
    # Two rows per task: regions that a cut runs through.
    edges = found.filter("edge is not null")
    centre = edges.groupBy("edge").agg(F.min("a").alias("b"))
    across = edges.select("a", "edge").join(centre, "edge").select("a", "b")
    both = found.filter("edge is null").select("a", "b").unionByName(across).filter("a <> b")
    pairs = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs, edges.select(F.col("edge").alias("region")).distinct()


def sorted_pairs(rows: DataFrame, n_rows: int) -> DataFrame:
    """The pairs of `first_look`."""
    return first_look(rows, n_rows)[0]


def candidates(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of documents that may be similar, by a first look, and the
    regions that it has cut.

    `signed` has doc_id and signature, one row per document."""
    spark = signed.sparkSession
    ship(spark)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per tree with that tree's values, and the low byte of all values."""
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            all_values = _matrix(batch["signature"], 4 * VALUES).view("<u4")
            marks = pa.array([m.tobytes() for m in all_values.astype(np.uint8)], pa.binary())
            for t in range(TREES):
                part = np.ascontiguousarray(all_values[:, t * DEPTH : (t + 1) * DEPTH])
                keys = pa.array([k.tobytes() for k in part], pa.binary())
                yield pa.record_batch(
                    [pa.array(np.full(len(ids), t, np.int32)), keys, pa.array(ids), marks],
                    ["tree", "key", "doc_id", "marks"],
                )

    rows = signed.select("doc_id", "signature").mapInArrow(
        narrow, "tree int, key binary, doc_id long, marks binary"
    )
    return first_look(rows, signed.count() * TREES)


def _matrix(column, width: int) -> np.ndarray:
    """Binary values of equal width as rows of bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
    return data[lo:hi].reshape(-1, width)


def shingle_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The full set of each document, as ascending 64-bit hashes: `set` binary."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                sets = [
                    words.shingles(words.word_hashes(words.lower_words(t.as_py()))).tobytes()
                    for t in part["text"]
                ]
                yield pa.record_batch([part["doc_id"], pa.array(sets, pa.binary())], ["doc_id", "set"])

    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(of, "doc_id long, set binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = words.shared(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            kept = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch["a"].filter(kept), batch["b"].filter(kept)], ["a", "b"])

    x = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def _sets_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The full sets of some documents, one of each id."""
    sets = shingle_sets(texts.join(few(settle(ids, "set-ids")), "doc_id", "left_semi"))
    return settle(sets.groupBy("doc_id").agg(F.min("set").alias("set")), "sets")


def _regions(signed: DataFrame) -> DataFrame:
    """Every document in every tree: region (the tree and its first values), doc_id,
    component and n_shingles."""
    keys = [
        F.concat(F.unhex(F.lit(f"{t:02x}")), F.substring("signature", 4 * DEPTH * t + 1, 4 * LEAST_DEPTH))
        for t in range(TREES)
    ]
    return signed.select(F.explode(F.array(*keys)).alias("region"), "doc_id", "component", "n_shingles")


def find_components(signed: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node and component of all documents with links: those of the first look, then those
    between the parts that it left of dense and of cut regions.

    `signed` has doc_id, n_shingles and signature, one row per document."""
    pairs, cut = candidates(signed)
    pairs, cut = settle(pairs, "pairs"), settle(cut, "cut-regions")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    links = settle(confirmed(pairs, _sets_of(ids, texts), percent), "links")
    found = components(links)
    named = signed.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = _regions(named.withColumn("component", F.coalesce("component", "doc_id")))
    regions = settle(dense.open_regions(placed, cut, SMALL), "open-regions")
    if regions.isEmpty():
        return found
    rows = placed.drop("n_shingles").join(few(regions.select("region")), "region", "left_semi")
    rows = settle(rows, "open-rows")
    sets = _sets_of(rows.select("doc_id").distinct(), texts)
    more = settle(dense.links(rows, regions, sets, percent), "dense-links")
    return found if more.isEmpty() else components(links.unionByName(more))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable) and kept, for every row."""
    if percent < PERCENT:
        raise ValueError(f"trees are laid out for {PERCENT} % and more")
    signed = settle(signatures(docs, doc_id, text), "signatures")
    known = signed.filter("digest is not null and doc_id is not null")
    first = F.min(F.struct("signature", "n_shingles")).alias("first")
    values = [F.first(c).alias(c) for c in ("signature", "n_shingles")]
    classes = settle(known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *values), "classes")
    one = settle(classes.groupBy("doc_id").agg(first).select("doc_id", "first.*"), "one-of-each")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = find_components(one, texts, percent)
    class_of = classes.select("digest", F.col("doc_id").alias("class_id"))
    named = class_of.join(found, F.col("class_id") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "class_id").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one document of each group; all columns stay. Rows that repeat both the
    id and the text of another are copies too."""
    found = settle(near_duplicates(docs, doc_id, text), "near")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    rest = docs.join(gone, F.col(doc_id).cast("long") == F.col("__gone"), "left_anti")
    ids = found.filter("doc_id is not null")
    if ids.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return rest
    return rest.dropDuplicates([doc_id, text])
