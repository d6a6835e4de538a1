"""Hard negatives of anchors, for windows of scores below each of their positives.

An anchor's positives are the best rows of its label. Each positive allows negatives (rows
of other labels) whose score lies between two shares of its own. The windows of one anchor
overlap: their upper limits, in descending order, cut the scores into disjoint slots. A
task keeps the k best negatives of each slot for each anchor, slots are merged over tasks,
and the answer of a window is a merge of the slots from its upper limit downwards, cut at
its lower limit: the k best of all scores below a limit are the k best of their slots.

Rows are dealt to tiles of bounded size by their number. Every tile gets all anchors, one
after another, and multiplies them in blocks; no pair of rows ever leaves a task unless it
is among the best there.

A score is the inner product of components floor(scale * x), exactly; it must fit a long.

Defined cases: rows with a null label, a null vector, or any null or non-finite component
take no part; components that a shorter vector lacks count as zero, empty vectors score 0.
Higher scores come first, ties by smaller id, a null id last, repeated ids by row. A row is
never its own partner, but every repeated row is a row of its own: repeated anchors are
answered each. Windows below negative positives are empty. Anchors without a positive and
positives without a negative have no row in the result; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.session import settle, ship

SCALE = 256
TILE_ROWS = 100_000
BLOCK_CELLS = 8_000_000  # scores held at once in a task

TOP = "anchor_row long, slot long, row long, id long, score long"
_NAMES = [x.split()[0] for x in TOP.split(", ")]


def _matrix(column: pa.ListArray, scale: float) -> np.ndarray:
    """The vectors of a batch as floor(scale * x), shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    width = int(sizes.max(initial=0))
    if width * len(sizes) == len(flat):
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole numbers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    # No partial sum exceeds the product of the longest vectors' lengths.
    bound = math.sqrt((a * a).sum(1).max(initial=0)) * math.sqrt((b * b).sum(1).max(initial=0))
    if bound < 2**23:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 2**52:
        return (a @ b.T).astype(np.int64)
    if bound < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("scores of these vectors do not fit a long")


class _Tile:
    """Rows of one tile, in the order of ties."""

    def __init__(self, batches: list[pa.RecordBatch], scale: float):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.rows = table["row"].to_numpy()
        self.ids = table["id"].combine_chunks()
        self.labels = table["label"].to_numpy()
        self.matrix = _stack([_matrix(b["vector"], scale) for b in batches])

    def best(self, scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Places of the k best of the rows `at`, best first."""
        s = scores[at]
        if len(at) > k:
            at = at[s >= np.partition(s, -k)[-k]]
            s = scores[at]
        return at[np.argsort(-s, kind="stable")[:k]]


def _top(tile: _Tile, anchors: pa.RecordBatch, scale: float, positives: int, negatives: int) -> Iterator[pa.RecordBatch]:
    """The best rows of a tile for each anchor: of its own label where it has no limits yet,
    else of other labels for each slot between its limits."""
    matrix = _matrix(anchors["vector"], scale)
    rows, labels = anchors["row"].to_numpy(), anchors["label"].to_numpy()
    uppers, lowest = anchors["uppers"].to_pylist(), anchors["lowest"].to_pylist()
    step = max(1, BLOCK_CELLS // max(1, len(tile.rows)))
    for lo in range(0, len(rows), step):
        found: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        scores = _products(matrix[lo : lo + step], tile.matrix)
        for k, own in enumerate(scores, lo):
            same = tile.labels == labels[k]
            if uppers[k] is None:
                at = tile.best(own, np.flatnonzero(same & (tile.rows != rows[k])), positives)
                found.append((rows[k], 0, at, own[at]))
                continue
            inside = np.flatnonzero(~same & (own >= lowest[k]) & (own <= uppers[k][0]))
            slots = np.searchsorted(-np.array(uppers[k]), -own[inside], "right") - 1
            for slot, upper in enumerate(uppers[k]):
                at = tile.best(own, inside[slots == slot], negatives)
                found.append((rows[k], upper, at, own[at]))
        if found:
            sizes = [len(x[2]) for x in found]
            places = np.concatenate([x[2] for x in found])
            columns = [
                pa.array(np.repeat(np.array([x[0] for x in found], np.int64), sizes)),
                pa.array(np.repeat(np.array([x[1] for x in found], np.int64), sizes)),
                pa.array(tile.rows[places]),
                tile.ids.take(pa.array(places)),
                pa.array(np.concatenate([x[3] for x in found])),
            ]
            yield pa.record_batch(columns, _NAMES)


def _meet(tiles: DataFrame, anchors: DataFrame, n: int, scale: float, positives: int, negatives: int) -> DataFrame:
    """What `_top` finds for every anchor in every tile; anchors have uppers and lowest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        tile: _Tile | None = None
        number = None
        for batch in batches:
            # Rows are ordered by tile, then the tile's own before the anchors.
            tile_of, kind = batch["tile"].to_numpy(), batch["kind"].to_numpy()
            cuts = np.flatnonzero((np.diff(tile_of) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(kind)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if number != tile_of[lo]:
                    held, tile, number = [], None, tile_of[lo]
                if kind[lo] == 0:
                    held.append(part)
                elif held or tile:
                    tile = tile or _Tile(held, scale)
                    held = []
                    yield from _top(tile, part, scale, positives, negatives)

    columns = ["tile", "kind", "row", "id", "label", "vector", "uppers", "lowest"]
    everywhere = anchors.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("kind", F.lit(1))
    own = tiles.withColumns(
        {
            "kind": F.lit(0),
            "uppers": F.lit(None).cast("array<bigint>"),
            "lowest": F.lit(None).cast("long"),
        }
    )
    both = own.select(columns).unionByName(everywhere.select(columns))
    dealt = both.repartitionById(n, F.col("tile"))
    ordered = dealt.sortWithinPartitions("tile", "kind", F.col("id").asc_nulls_last(), "row")
    return ordered.mapInArrow(work, TOP)


def _first(frame: DataFrame, keys: list[str], k: int, place: str) -> DataFrame:
    """The k best of each group; groups are bounded by k for each tile."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), "row"]
    ranked = frame.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(place) <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    lower: int = 50,
    upper: int = 95,
    scale: float = SCALE,
    row_id: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` tells which rows are anchors; `label` is a whole number; `lower` and `upper`
    are per cent of a positive's score."""
    spark = rows.sparkSession
    ship(spark)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col(label) if isinstance(label, str) else label
    plain = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(row_id).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    # Settled, so that the numbers of rows are the same in all jobs.
    table = settle(plain, "negatives-rows")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // tile_rows))
    tiles = table.withColumn("tile", F.pmod("row", F.lit(n)).cast("int")).drop("is_anchor")
    anchors = table.filter("is_anchor").drop("is_anchor")

    no_limits = anchors.withColumns(
        {"uppers": F.lit(None).cast("array<bigint>"), "lowest": F.lit(None).cast("long")}
    )
    near = _first(_meet(tiles, no_limits, n, scale, positives, negatives), ["anchor_row"], positives, "place")
    limits = near.select(
        "anchor_row",
        "place",
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.floor(F.col("score") * F.lit(upper).cast("decimal(20,0)") / 100).cast("long").alias("most"),
        F.ceil(F.col("score") * F.lit(lower).cast("decimal(20,0)") / 100).cast("long").alias("least"),
    )
    windows = settle(limits.filter("least <= most"), "negatives-windows")

    slots = windows.groupBy("anchor_row").agg(
        F.sort_array(F.collect_set("most"), asc=False).alias("uppers"), F.min("least").alias("lowest")
    )
    bounded = anchors.join(slots, anchors.row == slots.anchor_row).drop("anchor_row")
    far = _first(_meet(tiles, bounded, n, scale, positives, negatives), ["anchor_row", "slot"], negatives, "nth")
    # At most positives * slots * negatives rows an anchor.
    below = windows.join(far, "anchor_row").filter("slot <= most")
    chosen = _first(below, ["anchor_row", "place"], negatives, "rank").filter("score >= least")
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return chosen.join(names, "anchor_row").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
