"""Turn rows that hold an item now and before into change records."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.profiles import Profile
from shelfdiff.schema import TEXT_COLUMNS


def _hits(profile: Profile) -> Column:
    """array<struct<kind, at>> of the changes that one row stands for."""

    def hit(kind: str, at: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(at).alias("at"))

    found = [
        F.when(F.col("judged") & F.expr(rule), hit(kind, "run_ts"))
        for kind, rule in profile.changes.items()
    ]
    if profile.gone_kind:
        found.append(F.when(F.col("gone_at").isNotNull(), hit(profile.gone_kind, "gone_at")))
    return F.array_compact(F.array(*found))


def _per_site(profiles: Iterable[Profile], value: Callable[[Profile], Column]) -> Column:
    """`value(profile)` for the row's site, NULL for a site without a profile."""
    return F.coalesce(*[F.when(F.col("site") == p.site, value(p)) for p in profiles])


def _is_gone(profile: Profile, kind: Column) -> Column:
    return kind == profile.gone_kind if profile.gone_kind else F.lit(False)


def _is_stored(profile: Profile, kind: Column) -> Column:
    return kind.isin(*profile.stored_text) if profile.stored_text else F.lit(False)


def _record(kind: Column, at: Column, gone: Column, stored: Column) -> list[Column]:
    """The columns of the change table for one hit on the row."""

    def before(now: str) -> Column:
        return F.when(gone, F.col(now)).otherwise(F.col(f"p_{now}"))

    def after(now: str) -> Column:
        return F.when(~gone, F.col(now))

    text = [F.when(stored, F.col(f"first_{c}")).otherwise(F.col(c)).alias(c) for c in TEXT_COLUMNS]
    return [
        F.col("site"),
        at.alias("run_ts"),
        kind.alias("kind"),
        F.col("item_id"),
        *text,
        before("price").alias("old_price"),
        after("price").alias("new_price"),
        before("full_price").alias("old_full"),
        after("full_price").alias("new_full"),
        before("bid_num").alias("old_num"),
        after("bid_num").alias("new_num"),
        F.col("end_ts"),
    ]


def nested_changes(rows: DataFrame, profile: Profile, name: str) -> DataFrame:
    """One site's `rows` with the changes each row stands for, as an array column."""

    def record(hit: Column) -> Column:
        kind = hit["kind"]
        return F.struct(*_record(kind, hit["at"], _is_gone(profile, kind), _is_stored(profile, kind)))

    return rows.withColumn(name, F.transform(_hits(profile), record))


def emit_changes(rows: DataFrame, profiles: Iterable[Profile]) -> DataFrame:
    """Explode every row into its changes: one pass, no matter how many kinds.

    `rows` has the columns named in `shelfdiff.profiles`, `first_<text>` for the stored
    text columns, `judged` (the row is a sighting, and some clean run came before) and
    `gone_at` (the clean run that misses the item, else NULL).
    """
    profiles = list(profiles)
    hits = rows.withColumn("_hit", F.explode(_per_site(profiles, _hits)))
    kind = F.col("_hit.kind")
    return hits.select(
        *_record(
            kind,
            F.col("_hit.at"),
            _per_site(profiles, lambda p: _is_gone(p, kind)),
            _per_site(profiles, lambda p: _is_stored(p, kind)),
        )
    )
