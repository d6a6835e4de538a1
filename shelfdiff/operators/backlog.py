"""Several runs of one site against the stored listing, in one pass.

Run by run, each run is judged against the listing that the one before it left. Within a
backlog that listing is an item's previous row: its last sighting, or, before the first, the
stored row. So all runs of a backlog take one window per item, however many they are, and
give what committing them one after another would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.operators.detect import Layered
from shelfdiff.operators.emit import nested_changes
from shelfdiff.profiles import Profile
from shelfdiff.schema import LISTING, MEASURES, TEXT_COLUMNS
from shelfdiff.session import settle
from shelfdiff.sizing import BROADCAST_ROWS, fits

# Runs of one pass: an item has at most one row per run, and a window holds an item's rows.
BACKLOG_RUNS = 10_000

_STATE = tuple(c for c in LISTING.names if c not in ("site", "item_id", "update_ts"))


def _clean_runs(runs: Sequence[tuple[datetime, int]], clean: datetime | None) -> list[tuple]:
    """(run, errors, clean run before, clean run after) of each run, in order."""
    after: list[datetime | None] = []
    newer = None
    for ts, error in reversed(runs):
        after.append(newer)
        newer = ts if error == 0 else newer
    out = []
    for (ts, error), later in zip(runs, reversed(after), strict=True):
        out.append((ts, error, clean, later))
        clean = ts if error == 0 else clean
    return out


def _stored(
    listing: DataFrame, items: DataFrame, first_clean: datetime | None, clean: datetime | None,
    profile: Profile, broadcast_rows: int,
) -> DataFrame:
    """Stored rows that the runs can touch: those of seen items and, where absence counts,
    those that the first clean run would miss."""
    gone = F.lit(None).cast("timestamp")
    if profile.gone_kind and first_clean is not None and clean is not None:
        gone = F.when(F.col("update_ts") >= F.lit(clean), F.lit(first_clean))
    keys = items.withColumn("_seen", F.lit(True))
    keys = F.broadcast(keys) if fits(items, broadcast_rows) else keys
    rows = listing.withColumn("missed_by", gone).join(keys, "item_id", "left")
    rows = rows.filter(F.col("_seen") | F.col("missed_by").isNotNull())
    return rows.select(
        "item_id",
        F.lit(True).alias("stored"),
        F.col("update_ts").alias("run_ts"),
        F.lit(None).cast("timestamp").alias("last_stable"),
        "missed_by",
        *_STATE,
    )


def backlog_rows(
    listing: Layered,
    snapshots: DataFrame,
    runs: Sequence[tuple[datetime, int]],
    clean: datetime | None,
    profile: Profile,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Listing rows with, in `found`, the changes they stand for: a row for every sighting
    as the listing is after it, and the stored rows of items that a run reports as gone.

    `runs` are (time, errors) in order, all newer than the listing; `clean` is the newest
    clean run before them. `snapshots` is de-duplicated and has rows of these runs only.
    """
    spark = snapshots.sparkSession
    around = _clean_runs(runs, clean)
    schema = "run_ts timestamp, error bigint, last_stable timestamp, next_stable timestamp"
    log = spark.createDataFrame(around, schema)
    own = snapshots.filter(F.col("site") == profile.site)
    missed = F.lit(None).cast("timestamp")
    if profile.gone_kind:
        judged_before = (F.col("error") == 0) | F.col("last_stable").isNotNull()
        missed = F.when(judged_before, F.col("next_stable"))
    sightings = own.join(F.broadcast(log), "run_ts").select(
        "item_id",
        F.lit(False).alias("stored"),
        "run_ts",
        "last_stable",
        missed.alias("missed_by"),
        *[F.col("run_ts").alias(c) if c == "record_ts" else F.col(c) for c in _STATE],
    )
    if listing.recent is None and listing.base.isEmpty():
        return after_each(sightings, profile)
    stored = listing.whole().filter(F.col("site") == profile.site)
    first_clean = next((ts for ts, error in runs if error == 0), None)
    # Counted and joined: the snapshots are read for it once.
    items = settle(own.select("item_id").distinct(), f"items-{profile.site}")
    rows = sightings.unionByName(_stored(stored, items, first_clean, clean, profile, broadcast_rows))
    return after_each(rows, profile)


def sighting_rows(
    listing: Layered, sightings: DataFrame, profile: Profile, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The same for sightings that know the clean run before their own (`last_stable`), in
    no order and of any runs; absence says nothing. Sightings that are no newer than what is
    stored of their item are left out."""
    own = sightings.filter(F.col("site") == profile.site)
    now = own.select(
        "item_id",
        F.lit(False).alias("stored"),
        "run_ts",
        "last_stable",
        F.lit(None).cast("timestamp").alias("missed_by"),
        *[F.col("run_ts").alias(c) if c == "record_ts" else F.col(c) for c in _STATE],
    )
    before = listing.whole().filter(F.col("site") == profile.site)
    known = _stored(before, own.select("item_id").distinct(), None, None, profile, broadcast_rows)
    rows = now.unionByName(known)
    stored_ts = F.max(F.when(F.col("stored"), F.col("run_ts"))).over(Window.partitionBy("item_id"))
    newer = F.col("stored") | F.col("_stored_ts").isNull() | (F.col("run_ts") > F.col("_stored_ts"))
    return after_each(rows.withColumn("_stored_ts", stored_ts).filter(newer).drop("_stored_ts"), profile)


def after_each(rows: DataFrame, profile: Profile) -> DataFrame:
    """One window per item over stored rows and sightings: the listing after each of them
    and the changes found there."""
    by_item = Window.partitionBy("item_id").orderBy("run_ts")
    so_far = by_item.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"p_ts": F.lag("run_ts").over(by_item), "n_ts": F.lead("run_ts").over(by_item)})
    rows = rows.withColumn("gone_at", F.when(F.col("n_ts").isNull() | (F.col("n_ts") > F.col("missed_by")), F.col("missed_by")))

    # The listing after the row, and before it: stored values stay but for the profile's own.
    moving = [c for c in _STATE if c in profile.update_cols]
    fixed = [c for c in _STATE if c not in profile.update_cols]
    first = F.first(F.struct(*fixed)).over(so_far)
    rows = rows.withColumn("_first", first).withColumn("_before", F.lag(F.struct(*moving)).over(by_item) if moving else F.lit(None))

    def after(c: str) -> Column:
        return F.col(c) if c in profile.update_cols else F.col(f"_first.{c}")

    def before(c: str) -> Column:
        known = F.col("p_ts").isNotNull()
        return F.when(known, F.col(f"_before.{c}") if c in profile.update_cols else F.col(f"_first.{c}"))

    state = F.struct(
        F.lit(profile.site).alias("site"),
        "item_id",
        *[after(c).alias(c) for c in _STATE],
        F.col("run_ts").alias("update_ts"),
    ).alias("_state")
    seen = rows.select(
        F.lit(profile.site).alias("site"),
        "item_id",
        "run_ts",
        "last_stable",
        *TEXT_COLUMNS,
        *MEASURES,
        "end_ts",
        "p_ts",
        *[before(c).alias(f"p_{c}") for c in MEASURES],
        *[before(c).alias(f"first_{c}") for c in TEXT_COLUMNS],
        (~F.col("stored") & F.col("last_stable").isNotNull()).alias("judged"),
        F.lit(None).cast("timestamp").alias("gone_at"),
        "stored",
        F.col("gone_at").alias("_gone_at"),
        state,
    )
    seen = nested_changes(seen, profile, "_seen_changes")
    # What a later run misses is the row as it is stored after this one.
    left = seen.withColumns(
        {
            **{c: F.col(f"_state.{c}") for c in (*TEXT_COLUMNS, *MEASURES, "end_ts")},
            **{f"first_{c}": F.col(f"_state.{c}") for c in TEXT_COLUMNS},
            "judged": F.lit(False),
            "gone_at": F.col("_gone_at"),
        }
    )
    left = nested_changes(left, profile, "_gone_changes")
    found = left.withColumn("found", F.concat("_seen_changes", "_gone_changes"))
    return found.filter(~F.col("stored") | (F.size("found") > 0)).select("_state.*", "found")
