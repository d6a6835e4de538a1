"""The change feed of a whole history in one job.

Run by run, a listing table remembers the last sighting of each item. Over the history
that memory is simply the previous row of the item, so the diff of all runs is one
window per item instead of a loop over runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.operators.emit import emit_changes
from shelfdiff.operators.runlog import attach_runs, run_bounds, with_stable
from shelfdiff.profiles import Profile
from shelfdiff.schema import MEASURES, TEXT_COLUMNS
from shelfdiff.sizing import BROADCAST_ROWS

# A de-duplicated item has at most one row per run, so the log bounds the rows that any
# one item can bring into a window task. Sites with more runs than this are cut into
# slices of that many runs.
ITEM_ROWS = 50_000

ITEM = ("site", "item_id")


def _one_window(rows: DataFrame) -> DataFrame:
    by_item = Window.partitionBy(*ITEM).orderBy("run_ts")
    so_far = by_item.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns(
        {
            "p_ts": F.lag("run_ts").over(by_item),
            "n_ts": F.lead("run_ts").over(by_item),
            **{f"p_{c}": F.lag(c).over(by_item) for c in MEASURES},
            **{f"first_{c}": F.first(c).over(so_far) for c in TEXT_COLUMNS},
        }
    )


def _sliced_windows(rows: DataFrame, slice_runs: int) -> DataFrame:
    """The same columns with no task holding more than `slice_runs` rows of an item.

    Neighbours inside a slice come from a window over the slice. The first and last row
    of a slice look across its edge, into a summary with one row per item and slice.
    """
    sliced = rows.withColumn("_slice", F.floor((F.col("run_no") - 1) / slice_runs))
    now = F.struct(F.col("run_ts").alias("ts"), *MEASURES)
    texts = F.struct(*TEXT_COLUMNS)
    by_slice = Window.partitionBy(*ITEM, "_slice").orderBy("run_ts")
    inner = sliced.withColumns(
        {"_before": F.lag(now).over(by_slice), "_next": F.lead("run_ts").over(by_slice)}
    )

    by_item = Window.partitionBy(*ITEM).orderBy("_slice")
    edges = (
        sliced.groupBy(*ITEM, "_slice")
        .agg(
            F.max_by(now, "run_ts").alias("_last"),
            F.min("run_ts").alias("_first"),
            F.min_by(texts, "run_ts").alias("_texts"),
        )
        .select(
            *ITEM,
            "_slice",
            F.lag("_last").over(by_item).alias("_edge_before"),
            F.lead("_first").over(by_item).alias("_edge_next"),
            F.first("_texts")
            .over(by_item.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            .alias("_origin"),
        )
    )
    joined = inner.join(edges, [*ITEM, "_slice"])
    before = F.coalesce("_before", "_edge_before")
    return joined.withColumns(
        {
            "p_ts": before["ts"],
            "n_ts": F.coalesce("_next", "_edge_next"),
            **{f"p_{c}": before[c] for c in MEASURES},
            **{f"first_{c}": F.col(f"_origin.{c}") for c in TEXT_COLUMNS},
        }
    ).drop("_slice", "_before", "_next", "_edge_before", "_edge_next", "_origin")


def item_sequence(
    snapshots: DataFrame,
    run_log: DataFrame,
    item_rows: int = ITEM_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Every sighting with its run's clean neighbours and the item's own neighbours.

    `snapshots` is de-duplicated: one row per (site, run_ts, item_id).
    """
    bounds = run_bounds(run_log)
    log = with_stable(run_log, bounds.widest).select(
        "site", "run_ts", "count", "error", "last_stable", "next_stable", "run_no"
    )
    rows = attach_runs(snapshots, log, bounds, broadcast_rows)
    if bounds.widest <= item_rows:
        return _one_window(rows)
    return _sliced_windows(rows, item_rows)


def _gone_at() -> Column:
    """The clean run that first misses the item after this sighting, else NULL.

    That run reports it if some clean run came before it: this one or an earlier one.
    """
    missed = F.col("n_ts").isNull() | (F.col("n_ts") > F.col("next_stable"))
    counted = (F.col("error") == 0) | F.col("last_stable").isNotNull()
    return F.when(missed & counted, F.col("next_stable"))


def replay(
    snapshots: DataFrame,
    run_log: DataFrame,
    profiles: Iterable[Profile],
    item_rows: int = ITEM_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Changes of all runs of all given profiles' sites, as running them one by one would
    have reported them."""
    seq = item_sequence(snapshots, run_log, item_rows, broadcast_rows)
    judged = seq.withColumns(
        {"judged": F.col("last_stable").isNotNull(), "gone_at": _gone_at()}
    )
    return emit_changes(judged, profiles)
