"""Exclusion rules: SQL predicates per site that remove item rows before the diff.

Rule text is SQL and runs with the session's rights: take it only from trusted users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def get_rules(
    rules: DataFrame, rule_id: int = 0, site: str | None = None, show_all: bool = False
) -> DataFrame:
    """All rules, else those of a site, else the one with an id, in that priority."""
    if show_all:
        return rules
    if site is not None:
        return rules.filter(F.col("site") == site)
    return rules.filter(F.col("rule_id") == rule_id)


def check_rules(df: DataFrame, predicates: list[str]) -> None:
    """Raise unless all of `predicates` are conditions over the columns of `df`."""
    tried = df.select(*[F.expr(p).alias(f"rule_{n}") for n, p in enumerate(predicates)])
    for predicate, column in zip(predicates, tried.schema):
        if not isinstance(column.dataType, T.BooleanType):
            raise ValueError(f"rule is not a condition: {predicate}")


def add_rule(rules: DataFrame, site: str, predicate: str, target: DataFrame) -> DataFrame:
    """`rules` with one more, under the next free id; `target` checks its text."""
    check_rules(target, [predicate])
    next_id = rules.agg((F.coalesce(F.max("rule_id"), F.lit(0)) + 1).alias("rule_id"))
    added = next_id.select("rule_id", F.lit(site).alias("site"), F.lit(predicate).alias("predicate"))
    return rules.unionByName(added)


def remove_rule(rules: DataFrame, rule_id: int) -> DataFrame:
    return rules.filter(F.col("rule_id") != rule_id)


def rule_texts(rules: DataFrame, site: str) -> list[str]:
    """A site's rules on the driver: they are hand-written text that becomes part of the
    plan, whatever the size of the data."""
    chosen = get_rules(rules, site=site).select("rule_id", "predicate").orderBy("rule_id")
    return [r["predicate"] for r in chosen.toLocalIterator()]


def hit_by(predicates: list[str]) -> Column:
    """True where any rule hits. A rule that is NULL for a row does not hit it: the
    greatest of booleans passes over NULLs, and stays flat however many rules there are."""
    return F.greatest(F.lit(False), F.lit(False), *[F.expr(p) for p in predicates])


def apply_rules(df: DataFrame, rules: DataFrame, site: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, one-row DataFrame with the number of rows removed).

    All rules of the site are one expression over one scan.
    """
    texts = rule_texts(rules, site)
    check_rules(df, texts)
    hit = hit_by(texts)
    return df.filter(~hit), df.agg(F.count_if(hit).alias("hits"))
