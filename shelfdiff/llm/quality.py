"""Quality rules whose cutoffs adapt to each language and source.

Every document gets a few measures. Per (language, source) a mergeable KLL quantile sketch
of each measure gives robust fences, quartile plus or minus `reach` spreads, and documents
outside a fence of their group are dropped. Groups with fewer than `min_group` documents
take the merged sketches of their language, and languages that are as small those of the
whole table. Built of DataFrame functions only.

Defined cases: a null text has no words; a null language or source is a group of its own;
documents without words have no ratios, fail the base rules and take no part in sketches;
repeated rows count as often as they occur; an empty table gives an empty result. Columns
other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.session import settle

# White space that ends a word, and characters that count as symbols.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A fence on one ratio. `spread` is the least width taken for the quartile distance:
    a ratio that is 0 nearly everywhere has none of its own."""

    ratio: str
    spread: float
    low: bool = False
    high: bool = True


RULES = (
    Rule("word_length", 0.75, low=True),
    Rule("symbol_share", 0.02),
    Rule("dup_line_share", 0.15),
    Rule("repeat_share", 0.06),
)

# KLL's accuracy parameter: groups of up to about this many documents are held exactly,
# larger ones within 0.1 % of rank.
SKETCH_K = 2048


def _last(value: Column, use) -> Column:
    """`use(value)`, with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """How many words lie in 5-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit hash. Only texts in which some hash repeats have
    theirs sorted; there a window repeats if it equals a neighbour in that order.
    """

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(starts: Column) -> Column:
        """Words under windows that begin at these ascending places."""
        reach = F.transform(
            starts,
            lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))),
        )
        return F.aggregate(reach, F.lit(0), lambda total, x: total + x)

    def repeated(hashes: Column) -> Column:
        def places(ordered: Column) -> Column:
            twin = lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (
                F.get(ordered, i + 1)["h"] == x["h"]
            )
            hits = F.filter(ordered, lambda x, i: F.coalesce(twin(x, i), F.lit(False)))
            return F.array_sort(F.transform(hits, lambda x: x["at"]))

        marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        found = _last(F.array_sort(marked), lambda o: _last(places(o), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)

    counted = F.when(F.size(words) > WINDOW, _last(windows(words), repeated))
    return F.coalesce(counted, F.lit(0))


def measures(docs: DataFrame, text: str = "text") -> list[Column]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of a text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, f"[{BLANK}]+"), lambda w: w != "")
    lines = F.filter(
        F.split(whole, "\n"), lambda x: F.length(F.translate(x, BLANK, "")) > 0
    )
    counts = _last(
        words,
        lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")),
    )
    by_line = _last(
        lines,
        lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")),
    )
    return [
        counts.alias("by_word"),
        by_line.alias("by_line"),
        F.length(F.translate(whole, BLANK, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    ]


def measured(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """The columns `keep`, the counts and the ratios of every document."""
    counted = docs.select(*keep, *measures(docs, text)).select(
        *keep,
        F.col("by_word.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("by_line.n").cast("long").alias("n_lines"),
        F.col("by_line.d").cast("long").alias("n_dup_lines"),
        F.col("by_word.r").cast("long").alias("n_repeat_words"),
    )
    some = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return counted.withColumns(
        {
            "word_length": some("word_chars", "n_words"),
            "symbol_share": some("n_symbols", "word_chars"),
            "dup_line_share": some("n_dup_lines", "n_lines"),
            "repeat_share": some("n_repeat_words", "n_words"),
            "base_failed": (F.col("n_words") < 10)
            | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        }
    )


def sketches(frame: DataFrame, by: tuple[str, str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per group with a quantile sketch of each ratio and the number of documents."""
    usable = frame.filter("n_words > 0")
    return usable.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.kll_sketch_agg_double(r.ratio, F.lit(SKETCH_K)).alias(r.ratio) for r in rules],
    )


def _merged(table: DataFrame, by: list[str], rules: tuple[Rule, ...], prefix: str) -> DataFrame:
    merge = [F.kll_merge_agg_double(r.ratio).alias(f"{prefix}{r.ratio}") for r in rules]
    return table.groupBy(*by).agg(F.sum("n_docs").alias(f"{prefix}n_docs"), *merge)


def fences(
    table: DataFrame,
    by: tuple[str, str],
    rules: tuple[Rule, ...] = RULES,
    reach: float = 3.0,
    min_group: int = 50,
) -> DataFrame:
    """Lower and upper cutoffs per group, from its sketches or those of a wider group."""
    outer, inner = by
    wide = _merged(table, [outer], rules, "w_").withColumnRenamed(outer, "w_key")
    all_of = _merged(table, [], rules, "a_")
    # The table of all groups together is a single row.
    joined = table.join(wide, F.col(outer).eqNullSafe(F.col("w_key"))).join(F.broadcast(all_of))
    out = [F.col(outer), F.col(inner)]
    for rule in rules:
        sketch = (
            F.when(F.col("n_docs") >= min_group, F.col(rule.ratio))
            .when(F.col("w_n_docs") >= min_group, F.col(f"w_{rule.ratio}"))
            .otherwise(F.col(f"a_{rule.ratio}"))
        )
        quartile = [F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.75)]
        width = F.greatest(quartile[1] - quartile[0], F.lit(rule.spread)) * reach
        if rule.low:
            out.append((quartile[0] - width).alias(f"{rule.ratio}_low"))
        if rule.high:
            out.append((quartile[1] + width).alias(f"{rule.ratio}_high"))
    return joined.select(*out)


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    by: tuple[str, str] = ("lang", "source"),
    rules: tuple[Rule, ...] = RULES,
    reach: float = 3.0,
    min_group: int = 50,
) -> DataFrame:
    """Every document with its measures, `base_failed` and `kept`.

    The measures are worked out once and written to the shared folder; sketches and the
    filter read them there. Fences are one narrow row per group; Spark broadcasts them if
    their size allows it, and otherwise splits groups that are large.
    """
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[F.col(c) for c in by]
    )
    table = settle(measured(plain, "text", "doc_id", *by), "measures")
    groups = settle(sketches(table, by, rules), "sketches")
    cut = fences(groups, by, rules, reach, min_group)
    cut = cut.withColumnsRenamed({c: f"g_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in by]
    judged = table.join(cut, same[0] & same[1], "left")
    inside = F.lit(True)
    for rule in rules:
        if rule.low:
            inside = inside & (F.col(rule.ratio) >= F.col(f"{rule.ratio}_low"))
        if rule.high:
            inside = inside & (F.col(rule.ratio) <= F.col(f"{rule.ratio}_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return judged.withColumn("kept", kept).drop(*[f"g_{c}" for c in by])
