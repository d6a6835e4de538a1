"""First-wins de-duplication of one run's item records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRIVAL = ("keyword", "page", "pos")


def dedup_first(
    observations: DataFrame,
    order: Sequence[str] = ARRIVAL,
    keys: Sequence[str] = ("site", "run_ts", "item_id"),
) -> DataFrame:
    """Keep the earliest record of every item of a run; a NULL item id is dropped.

    A minimum over (order, rest) structs, not a row_number window: it is combined on the
    map side, so an item repeated over a third of all pages reaches its reducer as one
    row per map task. Equal `order` values fall back on the other columns, so the result
    is the same every time.
    """
    rest = [c for c in observations.columns if c not in keys and c not in order]
    firsts = (
        observations.filter(F.col("item_id").isNotNull())
        .groupBy(*keys)
        .agg(F.min(F.struct(*order, *rest)).alias("_r"))
    )
    return firsts.select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in observations.columns]
    )
