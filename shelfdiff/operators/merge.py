"""Upsert of a snapshot into the listing, and the listing as a function of history."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.operators.detect import Layered, Run, judged_rows, side_by_side, touched_pairs
from shelfdiff.operators.emit import nested_changes
from shelfdiff.profiles import Profile
from shelfdiff.schema import CHANGES, LISTING

KEYS = ("site", "item_id")


def _merged(profile: Profile) -> dict[str, Column]:
    """Stored values survive but for the profile's own update columns.

    Which side wins depends on whether a row is there, not on NULLs: a newly seen NULL
    price overwrites, a stored NULL title stays.
    """
    seen, known = F.col("now").isNotNull(), F.col("old").isNotNull()
    columns: dict[str, Column] = {"item_id": F.col("item_id")}
    for c in LISTING.names:
        if c == "item_id":
            continue
        if c == "update_ts":
            value = F.when(seen, F.col("now.run_ts")).otherwise(F.col("old.update_ts"))
        elif c == "record_ts":
            value = F.when(known, F.col("old.record_ts")).otherwise(F.col("now.run_ts"))
        elif c in profile.update_cols:
            value = F.when(seen, F.col(f"now.{c}")).otherwise(F.col(f"old.{c}"))
        else:
            value = F.when(known, F.col(f"old.{c}")).otherwise(F.col(f"now.{c}"))
        columns[c] = value
    return {c: columns[c] for c in LISTING.names}


def merge(listing: DataFrame, snapshot: DataFrame, run: Run, profile: Profile) -> DataFrame:
    """The site's listing after the run: updates matches, inserts the rest, deletes nothing."""
    pairs = side_by_side(snapshot, listing, run)
    return pairs.select(*[v.alias(c) for c, v in _merged(profile).items()])


def touched_rows(
    listing: DataFrame | Layered, snapshot: DataFrame, run: Run, profile: Profile
) -> DataFrame:
    """The rows of `merge` that the run sees or reports on, each with, in `found`, the
    changes it stands for: one join serves both. All other rows stay as they are.

    A commit writes this once; the change feed is then a filtered read of what was written.
    """
    pairs = touched_pairs(snapshot, listing, run, profile)
    merged = F.struct(*[v.alias(c) for c, v in _merged(profile).items()]).alias("_merged")
    seen = F.col("now").isNotNull().alias("_seen")
    rows = nested_changes(judged_rows(pairs, run, profile, merged, seen), profile, "found")
    return rows.filter(F.col("_seen") | (F.size("found") > 0)).select("_merged.*", "found")


def changes_of(touched: DataFrame) -> DataFrame:
    """The change feed out of written `touched_rows`."""
    return touched.select(F.explode("found").alias("f")).select(
        *[F.col(f"f.{c}") for c in CHANGES.names]
    )


def listing_state(
    snapshots: DataFrame, profiles: Iterable[Profile], run_log: DataFrame | None = None
) -> DataFrame:
    """The listing that merging every run in order would leave, as one aggregation.

    With `run_log`, only the runs in it count: snapshots of a store may have landed for
    runs that were never committed.

    A site's update columns take the value of the newest sighting, NULL included; the
    others that of the first. Partial aggregation keeps one row per item and map task, so
    no item is too hot.
    """
    profiles = list(profiles)
    if run_log is not None:
        logged = run_log.select("site", "run_ts").distinct()
        snapshots = snapshots.join(logged, ["site", "run_ts"], "left_semi")
    updated = {c: [p.site for p in profiles if c in p.update_cols] for c in LISTING.names}
    stored = [c for c in LISTING.names if c not in (*KEYS, "record_ts", "update_ts")]
    moving = [c for c in stored if updated[c]]
    fixed = [c for c in stored if len(updated[c]) < len(profiles)]
    ts = F.col("run_ts")
    grouped = (
        snapshots.filter(F.col("site").isin(*[p.site for p in profiles]))
        .groupBy(*KEYS)
        .agg(
            F.min_by(F.struct(*fixed), ts).alias("_first"),
            F.max_by(F.struct(*moving), ts).alias("_last"),
            F.min(ts).alias("record_ts"),
            F.max(ts).alias("update_ts"),
        )
    )

    def value(c: str) -> Column:
        if c not in stored:
            return F.col(c)
        if c not in fixed:
            return F.col(f"_last.{c}").alias(c)
        if c not in moving:
            return F.col(f"_first.{c}").alias(c)
        newest = F.col("site").isin(*updated[c])
        return F.when(newest, F.col(f"_last.{c}")).otherwise(F.col(f"_first.{c}")).alias(c)

    return grouped.select(*[value(c) for c in LISTING.names])
