"""Which pages to fetch, and pages as row windows of a table."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# At most 12 pages per keyword, and the page sizes of the three sites.
MAX_PAGES = 12
PAGE_SIZE = {"lashinbang": 100, "mercari": 120, "yahoo": 100}

# Slices that the rows of one key are cut into where a top-n must not meet them at once.
SLICES = 256


def page_plan(first_pages: DataFrame, last_page: Column, keys: Sequence[str]) -> DataFrame:
    """One row per page of a keyword: all up to its last page, 12 at most.

    A first page that could not be read tells no last page and plans itself only, as does
    one that tells 0.
    """
    told = F.greatest(F.coalesce(last_page, F.lit(1)), F.lit(1))
    pages = F.least(told, F.lit(MAX_PAGES)).cast("int")
    return first_pages.select(*keys, F.explode(F.sequence(F.lit(1), pages)).alias("page"))


def page_params(plan: DataFrame) -> DataFrame:
    """Add the request window of each planned page: `first_row` and `n_rows`.

    One site counts rows from 0, one from 1, and one serves its newest rows only.
    """
    page, site = F.col("page"), F.col("site")
    size = F.lit(None).cast("int")
    for name, rows in PAGE_SIZE.items():
        size = F.when(site == name, rows).otherwise(size)
    first = (
        F.when(site == "lashinbang", (page - 1) * size)
        .when(site == "yahoo", (page - 1) * size + 1)
        .when(site == "mercari", 0)
    )
    return plan.withColumns({"first_row": first, "n_rows": size})


def page_window(df: DataFrame, order: Sequence[Column], page: int, size: int = 100) -> DataFrame:
    """The rows of one page of an ordered table; every task keeps its top rows only."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def newest_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows per key.

    Spark limits groups before the shuffle, so a keyword with a third of all rows sends `n`
    rows per map task. Only above `spark.sql.optimizer.windowGroupLimitThreshold` it does
    not: then every key is first cut to `n` rows per slice of its rows.
    """
    threshold = df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if n >= int(threshold):
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)))
        place = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
        df = sliced.withColumn("_place", place).filter(F.col("_place") <= n).drop("_slice", "_place")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("rank_no", rank).filter(F.col("rank_no") <= n)


def keywords(config: Column) -> Column:
    """A JSON map site -> list of keywords, as rows' struct array (site, keyword)."""
    parsed = F.from_json(config, "map<string,array<string>>")
    per_site = F.transform(
        F.map_entries(parsed),
        lambda e: F.transform(
            e["value"], lambda k: F.struct(e["key"].alias("site"), k.alias("keyword"))
        ),
    )
    return F.flatten(per_site)


def keywords_text(lists: dict[str, list[str]]) -> str:
    return json.dumps(lists, ensure_ascii=False)
