"""Small Spark helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a table of a few numbers that may be broadcast: some tens of MB.
FEW_ROWS = 500_000


def few(table: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """`table`, to be broadcast if it has at most `rows` rows; counts no more than that.

    For narrow tables that were settled before: counting them is cheap."""
    if table.select(F.lit(1)).limit(rows + 1).count() <= rows:
        return F.broadcast(table)
    return table
