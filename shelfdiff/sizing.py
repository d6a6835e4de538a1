"""Checks of the size of a side before it is broadcast or collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few narrow columns: some tens of MB at most once built into a hash table.
BROADCAST_ROWS = 500_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if `df` has at most `rows` rows; reads no more than it must to know."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows
