"""Best-fit packing of token sequences by linear grouping.

Documents longer than a sequence are cut; every other piece stays whole. Large pieces are
ordered by length and cut into groups of equal cardinality, whose lengths are all rounded
up to the largest. For these few sizes, configurations that fill a sequence best are
chosen and repeated as often as the groups allow; then the actual pieces take the places.
Small pieces fill what is left, largest first and into the tightest gap.

The driver sees only histograms of at most one entry per length, and plans ranges: pieces
lo..hi of a length go to sequences from such a number on. A piece finds its place by its
rank among equal lengths, which tasks count for themselves and a sum over tasks turns into
a rank among all. No task gathers a length, however many pieces have it.

Defined cases: null and empty texts have just the end id; repeated rows are packed as
often as they occur; a null document id is kept; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.llm import tokens, words
from shelfdiff.session import settle, ship

CAPACITY = 4096
END_ID = 1
GROUPS = 256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    path = tokenizer or tokens.default_path()
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        encoder = tokens.encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for i, t in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                data = encoder.ids(t.as_py()) + end
                for k in range(0, len(data), 4 * capacity):
                    part = data[k : k + 4 * capacity]
                    rows.append((i, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(cut, PIECES)


def _ranked(frame: DataFrame, by: str, name: str) -> DataFrame:
    """`frame` settled, with `rank`: from 0 on, unique among rows with equal `by`.

    Each task numbers the rows of each value that it sees; the counts of earlier tasks are
    added. The values of `by` are few (lengths), the rows of one may be many."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            nth = []
            for value in batch[by].to_pylist():
                nth.append(n := seen.get(value, 0))
                seen[value] = n + 1
            columns = [*batch.columns, pa.array([part] * len(nth), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.record_batch(columns, [*batch.schema.names, "part", "nth"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
    table = settle(frame.mapInArrow(number, f"{schema}, part int, nth long"), name)
    counts = table.groupBy("part", by).agg(F.count(F.lit(1)).alias("n"))
    # One row per task in each group.
    earlier = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", by, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    joined = table.join(bases, ["part", by])
    return joined.withColumn("rank", F.col("base") + F.col("nth")).drop("part", "nth", "base")


@dataclass
class Ranges:
    """Places of ranges of pieces: piece number lo + i goes to bin first + i // each when
    `stride` is 0, else to bin first + i % stride."""

    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)

    def add(self, lo: int, hi: int, home: int, first: int, each: int, stride: int = 0) -> None:
        if hi > lo:
            self.rows.append((lo, hi, home, first, each, stride))

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(home, bin) of each piece number."""
        table = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        row = table[np.searchsorted(table[:, 0], at, "right") - 1]
        i = at - row[:, 0]
        by_round = i % np.maximum(row[:, 5], 1)
        return row[:, 2], row[:, 3] + np.where(row[:, 5] > 0, by_round, i // np.maximum(row[:, 4], 1))


def best_configuration(sizes: list[int], left: list[int], first: int, capacity: int) -> dict[int, int]:
    """How many of each group fill `capacity` best, one of group `first` included."""
    room = capacity - sizes[first]
    parent = np.full(room + 1, -1, np.int64)
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    for g in range(first, len(sizes)):
        size = sizes[g]
        copies = min(left[g] - (g == first), room // size if size else 0)
        for _ in range(copies):
            new = np.flatnonzero(reached[: room + 1 - size]) + size
            new = new[~reached[new]]
            if not len(new):
                break
            reached[new] = True
            parent[new] = g
        if reached[room]:
            break
    config = {first: 1}
    at = int(np.flatnonzero(reached)[-1])
    while at:
        g = int(parent[at])
        config[g] = config.get(g, 0) + 1
        at -= sizes[g]
    return config


def plan_large(histogram: dict[int, int], capacity: int, groups: int) -> tuple[Ranges, int]:
    """Places of all pieces of `histogram`, numbered from the longest on, and how many
    sequences they take. Every length is at most `capacity`."""
    lengths = sorted(histogram, reverse=True)
    total = sum(histogram.values())
    sizes: list[int] = []
    counts: list[int] = []
    if len(lengths) <= groups:
        sizes, counts = lengths, [histogram[x] for x in lengths]
    else:
        ends = np.cumsum([histogram[x] for x in lengths])
        cuts = [g * total // groups for g in range(groups + 1)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                # Its longest piece gives a group its size.
                size = lengths[int(np.searchsorted(ends, lo, "right"))]
                if sizes and sizes[-1] == size:
                    counts[-1] += hi - lo
                else:
                    sizes.append(size)
                    counts.append(hi - lo)
    starts = np.concatenate([[0], np.cumsum(counts)]).tolist()
    left, used = list(counts), [0] * len(counts)
    places, sequences = Ranges(), 0
    first = 0
    while first < len(sizes):
        if not left[first]:
            first += 1
            continue
        config = best_configuration(sizes, left, first, capacity)
        times = min(left[g] // n for g, n in config.items())
        for g, n in config.items():
            lo = starts[g] + used[g]
            places.add(lo, lo + n * times, 0, sequences, 1, times)
            used[g] += n * times
            left[g] -= n * times
        sequences += times
    return places, sequences


def plan_small(
    histogram: dict[int, int], gaps: dict[int, int], capacity: int
) -> tuple[dict[int, Ranges], int]:
    """Best fit of small pieces, largest first, into gaps: per length, the places of its
    pieces as (home, bin), where bins of home g > 0 are the sequences with a gap of g, by
    rank, and those of home 0 are new. Also how many new ones there are."""
    # Bins alike: room left -> [(home, first bin, bins)].
    free: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    for gap, n in gaps.items():
        free[gap].append((gap, 0, n))
    fresh = 0
    plan: dict[int, Ranges] = {}
    for length in sorted(histogram, reverse=True):
        ranges = plan[length] = Ranges()
        done, todo = 0, histogram[length]
        room = length
        while todo:
            while room <= capacity and not free[room]:
                room += 1
            each = min(room, capacity) // length
            if room > capacity:
                # No gap is left: as many new sequences as this length fills.
                room, bins = capacity, -(-todo // each)
                free[capacity].append((0, fresh, bins))
                fresh += bins
            home, first, bins = free[room].pop()
            each = room // length
            full = min(bins, todo // each)
            if full:
                ranges.add(done, done + full * each, home, first, each)
                free[room - each * length].append((home, first, full))
                done, todo = done + full * each, todo - full * each
            if full < bins:
                if todo and todo < each:
                    ranges.add(done, done + todo, home, first + full, todo)
                    free[room - todo * length].append((home, first + full, 1))
                    done, todo, full = done + todo, 0, full + 1
                if full < bins:
                    free[room].append((home, first + full, bins - full))
            room = length
    return plan, fresh


def _histogram(counts: DataFrame, by: str) -> dict[int, int]:
    """At most one entry per length: bounded by the capacity."""
    return {r[by]: r["n"] for r in counts.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    small: int | None = None,
) -> DataFrame:
    """Every piece with its sequence_id and its offset there.

    Pieces of at most `small` tokens (default: an eighth of the capacity) fill gaps."""
    small = capacity // 8 if small is None else small
    pieces = _ranked(cut_documents(docs, tokenizer, doc_id, text, capacity), "length", "pieces")
    counts = _histogram(pieces, "length")
    large = {x: n for x, n in counts.items() if x > small}
    places, sequences = plan_large(large, capacity, groups)
    # Large pieces are numbered from the longest on.
    before, number = {}, 0
    for length in sorted(large, reverse=True):
        before[length] = number
        number += large[length]

    columns = [f"{c.name} {c.dataType.simpleString()}" for c in pieces.schema]

    def placed(plan, key: str, names: list[str], schema: str):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                home, at = plan(np.asarray(batch[key]), np.asarray(batch["rank"]))
                yield pa.record_batch([*batch.columns, pa.array(home), pa.array(at)], [*batch.schema.names, *names])

        return lambda frame: frame.mapInArrow(place, ", ".join([*columns, schema]))

    def large_place(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(length):
            return rank, rank
        starts = np.array([before[x] for x in length.tolist()], np.int64)
        return places.find(starts + rank)

    put_large = placed(large_place, "length", ["home", "sequence_id"], "home long, sequence_id long")
    first = settle(put_large(pieces.filter(F.col("length") > small)).drop("home"), "large")

    totals = first.groupBy("sequence_id").agg((capacity - F.sum("length")).alias("gap"))
    open_bins = _ranked(totals.filter("gap > 0"), "gap", "gaps")
    little = {x: n for x, n in counts.items() if x <= small}
    plan, _ = plan_small(little, _histogram(open_bins, "gap") if little else {}, capacity)

    def small_place(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        home, at = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for x in np.unique(length).tolist():
            mine = length == x
            home[mine], at[mine] = plan[x].find(rank[mine])
        return home, at

    put_small = placed(small_place, "length", ["home", "bin"], "home long, bin long")
    second = put_small(pieces.filter(F.col("length") <= small))
    bins = open_bins.select(F.col("gap").alias("home"), F.col("rank").alias("bin"), "sequence_id")
    second = second.join(bins, ["home", "bin"], "left").withColumn(
        "sequence_id", F.when(F.col("home") == 0, F.col("bin") + sequences).otherwise(F.col("sequence_id"))
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    everything = first.select(*names, "sequence_id", "rank").unionByName(
        second.select(*names, "sequence_id", "rank")
    )
    # At most `capacity` pieces to a sequence.
    earlier = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), "rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0))
    return everything.select(*names, "sequence_id", offset.alias("offset"))
