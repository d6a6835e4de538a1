"""Links between the parts that a first look has left of dense regions.

`forest` compares documents of a large region with hubs and their best partners only, and
those on both sides of a cut of its ranges by hubs alone. That finds most links, and so
most components; here all others follow. A region whose documents belong to several
components so far is open. Its rows outside its largest component are held against all of
its rows, block against block and on full sets, so that no link between two components is
left out; pairs within a component add nothing. A block has about `BLOCK` rows and
`BLOCK_SHINGLES` shingles at most, however large a region is, and a task holds two.

Pairs stay inside the tasks: what comes out of a cell are the links that tie components
together there, fewer than the cell has rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.spark_tools import few
from shelfdiff.session import settle

BLOCK = 1024
BLOCK_SHINGLES = 1_000_000

CELL = ["region", "i", "k"]
Side = tuple[np.ndarray, np.ndarray, list[np.ndarray]]


def cell_links(left: Side, right: Side, percent: int) -> list[tuple[int, int]]:
    """Links between rows of two sides (ids, components, sets) that tie components.

    Each row of the left counts the shingles that it shares with every row of the right."""
    (ids, mine, sets), (others, theirs, other_sets) = left, right
    mine, theirs = mine.copy(), theirs.copy()
    sizes = np.array([len(s) for s in other_sets])
    starts = np.cumsum(sizes) - sizes
    known, numbers = np.unique(np.concatenate(other_sets), return_inverse=True)
    marked = np.zeros(len(known), bool)
    found = []
    for row, own in enumerate(sets):
        apart = theirs != mine[row]
        if not apart.any():
            continue
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = at[known[at] == own]
        marked[at] = True
        both = np.add.reduceat(marked[numbers], starts, dtype=np.int64)
        marked[at] = False
        linked = np.flatnonzero(apart & (both > 0) & (100 * both >= percent * (len(own) + sizes - both)))
        for other in linked:
            old, new = theirs[other], mine[row]
            if old != new:
                found.append((int(ids[row]), int(others[other])))
                mine[mine == old] = new
                theirs[theirs == old] = new
    return found


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one cell after another, of batches sorted by cell."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(*(batch[c].to_pylist() for c in CELL), strict=True))
        lo = 0
        for at in range(len(keys)):
            if keys[at] != last:
                if at > lo:
                    held.append(batch.slice(lo, at - lo))
                if held:
                    yield pa.Table.from_batches(held)
                held, lo, last = [], at, keys[at]
        if len(keys) > lo:
            held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


def open_regions(placed: DataFrame, cut: DataFrame, small: int) -> DataFrame:
    """The regions to look at again: of several components, and large or cut. A region's
    largest component is its main one; blocks of the others come first.

    `placed` has region, doc_id, component and n_shingles; `cut` has region, each once."""
    counts = placed.groupBy("region", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles")
    )
    sizes = counts.groupBy("region").agg(
        F.sum("n").alias("rows"),
        F.sum("shingles").alias("shingles"),
        F.max(F.struct("n", "component", "shingles")).alias("most"),
        F.count(F.lit(1)).alias("parts"),
    )
    several = sizes.filter("parts > 1")
    marked = several.join(few(settle(cut.select("region", F.lit(True).alias("cut")), "cuts")), "region", "left")
    chosen = marked.filter((F.col("rows") > small) | F.col("cut"))

    def blocks(rows: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))

    others = blocks(F.col("rows") - F.col("most.n"), F.col("shingles") - F.col("most.shingles"))
    return chosen.select(
        "region",
        F.col("most.component").alias("main"),
        others.alias("others"),
        (others + blocks(F.col("most.n"), F.col("most.shingles"))).alias("blocks"),
    )


def links(placed: DataFrame, regions: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a < b) that tie all components of open regions that any link ties.

    `placed` has region, doc_id and component of the rows of those regions, `sets` doc_id
    and set (ascending 64-bit hashes), one row per document."""
    mine = F.col("component") == F.col("main")
    own_blocks = F.when(mine, F.col("blocks") - F.col("others")).otherwise(F.col("others"))
    block = F.pmod(F.xxhash64("region", "doc_id"), own_blocks) + F.when(mine, F.col("others")).otherwise(0)
    rows = placed.join(few(regions), "region").withColumn("block", block)
    # Cell (i, k): block i of the others is left, block k >= i of all is right.
    as_left = F.transform(
        F.sequence("block", F.col("blocks") - 1),
        lambda k: F.struct(F.col("block").alias("i"), k.alias("k"), F.lit(True).alias("left")),
    )
    as_right = F.transform(
        F.sequence(F.lit(0).cast("long"), F.least("block", F.col("others") - 1)),
        lambda i: F.struct(i.alias("i"), F.col("block").alias("k"), F.lit(False).alias("left")),
    )
    both = F.when(mine, as_right).otherwise(F.concat(as_left, as_right))
    dealt = rows.select("region", "doc_id", "component", F.inline(both)).join(sets, "doc_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            ids, components = cell["doc_id"].to_numpy(), cell["component"].to_numpy()
            found = [np.frombuffer(s.as_buffer(), np.uint64) for s in cell["set"]]
            left = cell["left"].to_numpy()
            sides = [
                (ids[at], components[at], [found[n] for n in at]) for at in (np.flatnonzero(left), np.flatnonzero(~left))
            ]
            if len(sides[0][0]) and len(sides[1][0]):
                pairs = np.array(cell_links(*sides, percent), np.int64).reshape(-1, 2)
                yield pa.record_batch([pa.array(pairs.min(1)), pa.array(pairs.max(1))], ["a", "b"])

    ordered = dealt.repartition(*CELL).sortWithinPartitions(*CELL)
    return ordered.mapInArrow(compare, "a long, b long").distinct()
