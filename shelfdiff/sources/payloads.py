"""Landed payload pages to observations, quarantine and page totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.profiles import Profile
from shelfdiff.schema import OBSERVATION
from shelfdiff.functions.text import page_count, strip_callback
from shelfdiff.sources.paging import MAX_PAGES

HTTP_OK = 200


def parse_pages(payload: DataFrame, profile: Profile) -> DataFrame:
    """One row per landed page: raw items (NULL = unreadable) and planned page count.

    A page counts as one error if its fetch failed, its body does not parse or its items
    are not where they belong.
    """
    fetched = (F.coalesce(F.col("status"), F.lit(HTTP_OK)) == HTTP_OK) & F.col("body").isNotNull()
    planned = F.lit(1).cast("bigint")
    if profile.paged:
        told = page_count(strip_callback(F.col("body")))
        planned = F.least(F.coalesce(F.when(fetched, told), F.lit(1)), F.lit(MAX_PAGES))
    return payload.filter(F.col("site") == profile.site).select(
        "site",
        "run_ts",
        "keyword",
        "page",
        F.when(fetched, profile.parse(F.col("body"))).alias("items"),
        planned.alias("planned"),
    )


def _lacks_field(item: Column, profile: Profile) -> Column:
    missing = F.lit(False)
    for name in profile.required:
        missing = missing | ~F.coalesce(F.map_contains_key(item, name), F.lit(False))
    return missing


def _exploded(pages: DataFrame, profile: Profile) -> DataFrame:
    """One row per raw item, one for a page without any; `reason` tells what is wrong.

    The outer form keeps the optimizer from repeating the parse in an inferred filter.
    """
    rows = pages.select(
        "site",
        "run_ts",
        "keyword",
        "page",
        F.col("items").isNull().alias("_bad"),
        F.posexplode_outer("items").alias("pos", "_item"),
    )
    lacks = F.col("pos").isNotNull() & _lacks_field(F.col("_item"), profile)
    return rows.withColumn("reason", F.when(F.col("_bad"), "page").when(lacks, "item"))


def observations_of(pages: DataFrame, profile: Profile) -> DataFrame:
    """Item rows of parsed pages, in page order; items that lack a field are left out."""
    rows = _exploded(pages, profile).filter(F.col("pos").isNotNull() & F.col("reason").isNull())
    known = profile.fields(F.col("_item"))
    columns = []
    for f in OBSERVATION:
        value = known.get(f.name)
        if value is None:
            value = F.col(f.name) if f.name in rows.columns else F.lit(None)
        columns.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*columns)


def quarantine_of(pages: DataFrame, profile: Profile) -> DataFrame:
    """What could not be used: (site, run_ts, keyword, page, pos, reason)."""
    rows = _exploded(pages, profile).filter(F.col("reason").isNotNull())
    return rows.select("site", "run_ts", "keyword", "page", "pos", "reason")


def project(payload: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(observations, quarantine) of a site's landed pages."""
    pages = parse_pages(payload, profile)
    return observations_of(pages, profile), quarantine_of(pages, profile)


def page_totals(pages: DataFrame, profile: Profile) -> DataFrame:
    """Errors, pages and items (before de-duplication) per run, without exploding items.

    Pages are the planned pages of each keyword's first page where a site has several,
    else its keywords.
    """
    bad = F.size(F.filter("items", lambda i: _lacks_field(i, profile)))
    size = F.size("items")
    if profile.paged:
        page = F.sum(F.when(F.col("page") == 1, F.col("planned")).otherwise(0))
    else:
        page = F.count_distinct("keyword")
    return pages.groupBy("site", "run_ts").agg(
        F.sum(F.when(F.col("items").isNull(), 1).otherwise(bad)).cast("bigint").alias("error"),
        page.cast("bigint").alias("page"),
        F.sum(F.when(F.col("items").isNull(), 0).otherwise(size - bad)).cast("bigint").alias("count"),
    )
