"""The run log: clean runs around each run, per-run counts, the alert flag."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfdiff.schema import RUN_LOG
from shelfdiff.sizing import BROADCAST_ROWS

# Runs of one site that one task may sort.
SITE_RUNS = 1_000_000

# A run with more than one part in so many of all items counts as hot, and the rows of
# hot runs are spread over so many shuffle keys per run.
HOT_RUNS = 1_000
SPREAD = 4_096


def last_stable(run_log: DataFrame) -> DataFrame:
    """Newest run without errors per site; NULL for a site that never had one."""
    clean = F.when(F.col("error") == 0, F.col("run_ts"))
    return run_log.groupBy("site").agg(F.max(clean).alias("last_ts"))


def with_stable(run_log: DataFrame, widest: int = 0, site_runs: int = SITE_RUNS) -> DataFrame:
    """Add the nearest clean run before and after each run, and the run's ordinal.

    The log has one narrow row per run, whatever the number of items, so a window per site
    does. `widest` is the counted number of runs of the site with the most: above
    `site_runs`, days are worked out on their own and joined to a summary of days.

    The run after is looked up in descending order: a frame that reaches to the end of its
    partition would be summed anew for every row.
    """
    clean = F.when(F.col("error") == 0, F.col("run_ts"))
    if widest <= site_runs:
        before, after, place = _around(["site"], "run_ts")
        return run_log.withColumns(
            {"last_stable": F.max(clean).over(before), "run_no": F.row_number().over(place)}
        ).withColumn("next_stable", F.min(clean).over(after))

    log = run_log.withColumn("_day", F.date_trunc("day", "run_ts"))
    before, after, _ = _around(["site"], "_day")
    days = (
        log.groupBy("site", "_day")
        .agg(F.max(clean).alias("_last"), F.min(clean).alias("_first"), F.count("*").alias("_n"))
        .select(
            "site",
            "_day",
            F.max("_last").over(before).alias("_before"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
            F.min("_first").over(after).alias("_after"),
        )
    )
    before, after, place = _around(["site", "_day"], "run_ts")
    own = log.withColumns(
        {"_own_before": F.max(clean).over(before), "_place": F.row_number().over(place)}
    ).withColumn("_own_after", F.min(clean).over(after))
    return own.join(days, ["site", "_day"]).select(
        *run_log.columns,
        F.coalesce("_own_before", "_before").alias("last_stable"),
        (F.col("_base") + F.col("_place")).alias("run_no"),
        F.coalesce("_own_after", "_after").alias("next_stable"),
    )


def _around(keys: list[str], order: str) -> tuple[WindowSpec, WindowSpec, WindowSpec]:
    """Windows over all rows before, all rows after (from the end), and in order."""
    forward = Window.partitionBy(*keys).orderBy(order)
    backward = Window.partitionBy(*keys).orderBy(F.desc(order))
    earlier = (Window.unboundedPreceding, -1)
    return forward.rowsBetween(*earlier), backward.rowsBetween(*earlier), forward


@dataclass(frozen=True)
class RunBounds:
    """How many runs and items the log holds in all, and runs for the site with the most."""

    total: int
    widest: int
    items: int


def run_bounds(run_log: DataFrame) -> RunBounds:
    per_site = run_log.groupBy("site").agg(F.count("*").alias("n"), F.sum("count").alias("items"))
    row = per_site.agg(
        F.sum("n").alias("total"), F.max("n").alias("widest"), F.sum("items").alias("items")
    ).first()
    return RunBounds(row["total"] or 0, row["widest"] or 0, row["items"] or 0)


def attach_runs(
    rows: DataFrame,
    log: DataFrame,
    bounds: RunBounds,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """Join run columns to item rows on (site, run_ts); `log` has the run's item `count`.

    The log is broadcast only if its counted size allows it. Beyond that it is shuffled,
    but for hot runs: one run may hold a third of all items. Runs with more than one part
    in `hot_runs` of all items, so fewer than `hot_runs` of them, are broadcast instead,
    and their rows take a spread key through the shuffle in place of their run's.
    """
    on = ["site", "run_ts"]
    columns = [c for c in log.columns if c not in (*on, "count")]
    if bounds.total <= broadcast_rows:
        return rows.join(F.broadcast(log.drop("count")), on)
    hot = F.coalesce(F.col("count") * hot_runs > F.lit(bounds.items), F.lit(False))
    hot_log = log.filter(hot).select(
        *on, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in columns]
    )
    cold_log = log.filter(~hot).select(
        *on, F.lit(0).alias("_spread"), F.lit(True).alias("_cold"), *columns
    )
    spread = F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.hash("item_id"), F.lit(SPREAD)))
    joined = (
        rows.join(F.broadcast(hot_log), on, "left")
        .withColumn("_spread", spread)
        .join(cold_log, [*on, "_spread"], "left")
        .filter(F.col("_hot").isNotNull() | F.col("_cold").isNotNull())
    )
    chosen = [
        F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in columns
    ]
    return joined.select(*rows.columns, *chosen)


def _kind_counts() -> dict[str, Column]:
    """The log has three counts. `sold` is the third kind of a site: sold items, bids on
    auction sites, whatever else a profile of one's own reports."""
    kind = F.col("kind")
    return {
        "new": F.count_if(kind == "new"),
        "discount": F.count_if(kind == "discount"),
        "sold": F.count_if(~kind.isin("new", "discount")),
    }


def _with_alert(summary: DataFrame) -> DataFrame:
    """The alert flag tells whether the run found anything at all."""
    return summary.withColumn("alert", F.col("new") + F.col("discount") + F.col("sold") > 0)


def run_summary(changes: DataFrame, runs: DataFrame) -> DataFrame:
    """One log row per run: its page and error counts with the changes it reported.

    Runs without changes stay, with zeros.
    """
    counts = _kind_counts()
    per_run = changes.groupBy("site", "run_ts").agg(*[v.alias(c) for c, v in counts.items()])
    joined = runs.drop(*counts).join(per_run, ["site", "run_ts"], "left")
    return _with_alert(joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}))


def one_run_summary(changes: DataFrame, totals: dict[str, object]) -> DataFrame:
    """`run_summary` for the changes of a single run whose other columns are known."""
    row = changes.agg(*[v.alias(c) for c, v in _kind_counts().items()])
    known = row.withColumns({c: F.lit(v) for c, v in totals.items()})
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG]
    return _with_alert(known.select(*columns))
