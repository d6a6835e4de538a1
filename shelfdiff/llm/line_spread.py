"""Boilerplate lines: those on many distinct sites, found with HyperLogLog sketches.

A line is what stands between two \\n, without white space at its ends; lines without a
word don't count. Every line hash carries a mergeable sketch of its sites. Lines whose
estimate is near `min_sites` get exact counts, lines far above are taken as spread.

Whole documents are copied from site to site as well, and their lines are no boilerplate:
near-duplicate removal is for those. So a spread line must also be held by `min_sites`
different texts, and copied documents don't count: those of which spread lines, two
different ones at least, are more than the share `most_shared` of the characters. A line is boilerplate if
`min_sites` sites and as many texts among all other documents have it, whatever stands
around it. This too is decided by sketches, and exactly where they are near a limit.

Built of DataFrame functions only. Hashes are Spark's 64-bit xxhash64.

Defined cases: a null text stays null and an empty one empty; a null site is a site of its
own; repeated rows are equal documents and add neither sites nor texts; blank lines are no
lines; a document all of whose lines go keeps its row with an empty text; an empty table gives an empty
result. Other columns are passed on untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.spark_tools import few
from shelfdiff.session import settle

# White space at the ends of a line.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"

# Sketches of 2**12 registers have a relative standard error of 1.6 %; three and a half
# of these on either side count as near.
LG_K = 12
NEAR = 0.06

# So many removed line hashes are put into the plan as literals (a hash set of some 100 kB);
# more of them are joined.
MAX_LITERALS = 5_000


def _key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.xxhash64(bare))


def _keys(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), _key)


def _lines(rows: DataFrame) -> DataFrame:
    """A row for each line with a word: its hash and length in place of the text."""
    # The outer form keeps the optimizer from splitting once more in an inferred filter.
    cut = rows.withColumn("bare", F.explode_outer(F.split("text", "\n"))).drop("text")
    bare = cut.withColumn("bare", F.btrim("bare", F.lit(BLANK))).filter("bare <> ''")
    return bare.withColumns({"line": F.xxhash64("bare"), "size": F.length("bare")}).drop("bare")


def _near(count: Column, limit: int) -> Column:
    # Estimates are whole numbers: one off is near as well.
    return count.between(limit * (1 - NEAR) - 1, limit * (1 + NEAR) + 1)


def _spread(spots: DataFrame, min_sites: int) -> DataFrame:
    """Lines of `spots` (line, site, content) with `min_sites` sites and as many texts."""
    counts = spots.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"),
        F.hll_sketch_estimate(F.hll_sketch_agg("content", F.lit(LG_K))).alias("contents"),
    )
    counts = settle(counts, "spread-counts")
    near = _near(F.col("sites"), min_sites) | _near(F.col("contents"), min_sites)
    clear = counts.filter(~near & (F.least("sites", "contents") >= min_sites)).select("line")
    close = counts.filter(near).select("line")
    exact = spots.select("line", "site", "content").join(few(close), "line", "left_semi").distinct()
    exact = settle(exact, "close")
    # Distinct counts one by one: each is a plain two-step aggregate that splits hot lines.
    sites, contents = (
        exact.select("line", c).distinct().groupBy("line").agg(F.count(F.lit(1)).alias(f"n_{c}"))
        for c in ("site", "content")
    )
    found = sites.join(contents, "line").filter(F.least("n_site", "n_content") >= min_sites)
    return settle(clear.union(found.select("line")), "spread-lines")


def spread_lines(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    min_sites: int = 10,
    most_shared: float = 0.5,
) -> DataFrame:
    """Hashes (`line`) of the boilerplate lines of `docs`."""
    place = F.coalesce(F.col(site).cast("string"), F.lit("\x00"))
    keyed = docs.select(place.alias("site"), F.col(text).alias("text"))
    # The first grouping merges repeats of a line within a site before the shuffle.
    sketched = _lines(keyed).groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites")
    )
    wide = sketched.filter((F.col("sites") >= min_sites) | _near(F.col("sites"), min_sites))
    wide = settle(wide.select("line"), "wide")

    # Where these lines stand: rows are numbered, as whole documents may repeat.
    numbered = keyed.withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "content": F.xxhash64("text"),
            "all_length": F.length("text"),
        }
    )
    spots = settle(_lines(numbered).join(few(wide), "line", "left_semi"), "spots")
    shared = spots.join(few(_spread(spots, min_sites)), "line", "left_semi")
    of_row = shared.groupBy("row").agg(
        F.first("site").alias("site"),
        F.first("content").alias("content"),
        F.first("all_length").alias("all_length"),
        F.sum("size").alias("shared_length"),
        F.collect_set("line").alias("lines"),
    )
    own = (F.size("lines") < 2) | (F.col("shared_length") <= F.col("all_length") * most_shared)
    counted = of_row.filter(own).select("site", "content", F.explode("lines").alias("line"))
    return _spread(settle(counted, "own-spots"), min_sites)


def remove_lines(
    docs: DataFrame,
    lines: DataFrame,
    text: str = "text",
    max_literals: int = MAX_LITERALS,
) -> DataFrame:
    """`docs` without the lines whose hashes are in `lines`.

    Few hashes become a literal set and nothing is shuffled; many are joined by hash, and
    texts by row, with hot lines split by Spark.
    """
    some = [r.line for r in lines.limit(max_literals + 1).collect()]
    if not some:
        return docs
    if len(some) <= max_literals:
        stays = lambda x: F.coalesce(~_key(x).isin(some), F.lit(True))
        rest = F.array_join(F.filter(F.split(F.col(text), "\n"), stays), "\n")
        return docs.withColumn(text, rest)
    # Equal texts lose equal lines: whole texts are named by two hashes.
    content = F.struct(F.xxhash64(F.col(text)).alias("a"), F.xxhash64(F.lit(1), F.col(text)).alias("b"))
    of = docs.select(content.alias("__text"), F.explode(F.array_distinct(_keys(F.col(text)))).alias("line"))
    hits = of.join(lines, "line", "left_semi").distinct()
    lists = hits.groupBy("__text").agg(F.collect_list("line").alias("__lines"))
    joined = docs.withColumn("__text", content).join(lists, "__text", "left")
    stays = lambda x: F.coalesce(~F.array_contains(F.col("__lines"), _key(x)), F.lit(True))
    rest = F.array_join(F.filter(F.split(F.col(text), "\n"), stays), "\n")
    out = joined.withColumn(text, F.when(F.col("__lines").isNull(), F.col(text)).otherwise(rest))
    return out.select(*docs.columns)


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    min_sites: int = 10,
    most_shared: float = 0.5,
) -> DataFrame:
    """`docs` without boilerplate lines; all rows and columns stay."""
    return remove_lines(docs, spread_lines(docs, text, site, min_sites, most_shared), text)
