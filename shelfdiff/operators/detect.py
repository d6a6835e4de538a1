"""Diff of one run's snapshot against the stored listing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.functions.times import as_utc, from_micros, micros
from shelfdiff.operators.emit import emit_changes
from shelfdiff.profiles import Profile
from shelfdiff.schema import LISTING, MEASURES, TEXT_COLUMNS
from shelfdiff.sizing import BROADCAST_ROWS, fits


@dataclass(frozen=True)
class Run:
    """The run being judged, its own errors, and what the log says about its site.

    `last` is the newest clean run before it, `newest` the newest run of any kind.
    """

    site: str
    run_ts: datetime
    error: int
    last: datetime | None
    newest: datetime | None = None

    @property
    def late(self) -> bool:
        """No newer than what the log holds: taking it would rewrite the past."""
        return self.newest is not None and self.run_ts <= self.newest


def open_run(run_log: DataFrame, site: str, run_ts: datetime, error: int = 0) -> Run:
    """Read a site's log as of `run_ts`: two values, so that the state filters built on
    them are literals that reach the parquet scan."""
    run_ts = as_utc(run_ts)
    own = run_log.filter(F.col("site") == site)
    clean = (F.col("error") == 0) & (F.col("run_ts") < F.lit(run_ts))
    row = own.agg(
        micros(F.max(F.when(clean, F.col("run_ts")))).alias("last"),
        micros(F.max("run_ts")).alias("newest"),
    ).first()
    return Run(site, run_ts, error, from_micros(row["last"]), from_micros(row["newest"]))


@dataclass(frozen=True)
class Layered:
    """A listing as a base, bucketed by item where it is stored, and the rows that runs
    since then have touched: at most one per item, in force over the base's."""

    base: DataFrame
    recent: DataFrame | None = None

    def map(self, work: Callable[[DataFrame], DataFrame]) -> Layered:
        return Layered(work(self.base), None if self.recent is None else work(self.recent))

    def whole(self, aligned: bool = False) -> DataFrame:
        """One table of all items. `aligned`: worked out bucket by bucket in one join, to be
        written as a base again; else the base's rows only pass by."""
        if self.recent is None:
            return self.base
        if not aligned:
            stale = self.recent.select("item_id")
            return self.base.join(stale, "item_id", "left_anti").select(*LISTING.names).unionByName(self.recent)
        rest = [c for c in LISTING.names if c != "item_id"]
        base = self.base.select("item_id", F.struct(*rest).alias("_old"))
        recent = self.recent.select("item_id", F.struct(*rest).alias("_new"))
        both = base.hint("merge").join(recent, "item_id", "full").withColumn("_row", F.coalesce("_new", "_old"))
        return both.select(*[F.col("item_id") if c == "item_id" else F.col(f"_row.{c}") for c in LISTING.names])


def layered(listing: DataFrame | Layered) -> Layered:
    return listing if isinstance(listing, Layered) else Layered(listing)


def _known_to(base: DataFrame, snapshot: DataFrame, run: Run, profile: Profile) -> DataFrame:
    """The part of the listing that a small snapshot can touch.

    Rows of the snapshot's items plus, where absence counts, rows seen since the last
    clean run. The listing is scanned, not shuffled.
    """
    keys = snapshot.select("item_id", F.lit(True).alias("_in_run"))
    marked = base.join(F.broadcast(keys), "item_id", "left")
    keep = F.col("_in_run")
    if profile.gone_kind and run.error == 0:
        keep = F.coalesce(keep, F.lit(False)) | (F.col("update_ts") >= F.lit(run.last))
    return marked.filter(keep).drop("_in_run")


def side_by_side(
    snapshot: DataFrame, listing: DataFrame | Layered, run: Run, how: str = "full"
) -> DataFrame:
    """Join both sides once on the item. Columns: `item_id`, `now`, `old` (NULL structs
    where a side lacks the item). Recent rows of a layered listing meet the snapshot first,
    so that the base takes part in one join only, and is not shuffled where it is stored."""
    layers = layered(listing)
    now = snapshot.filter(F.col("site") == run.site).select(
        "item_id", F.struct(*[c for c in snapshot.columns if c != "item_id"]).alias("now")
    )

    def stored(rows: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[c for c in LISTING.names if c != "item_id"]).alias(name)
        return rows.filter(F.col("site") == run.site).select("item_id", row)

    old = stored(layers.base, "old")
    if layers.recent is None:
        return now.join(old, "item_id", how)
    fresh = now.join(stored(layers.recent, "recent"), "item_id", how)
    both = fresh.join(old, "item_id", how)
    return both.select("item_id", "now", F.coalesce("recent", "old").alias("old"))


def touched_pairs(
    snapshot: DataFrame,
    listing: DataFrame | Layered,
    run: Run,
    profile: Profile,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """`side_by_side` of the items that the run can touch. A snapshot whose counted size
    allows it is broadcast against the listing; a larger one is sort-merged with it on the
    item, which is unique on both sides."""
    layers = layered(listing)
    how = "full" if profile.gone_kind and run.error == 0 and run.last is not None else "left"
    if fits(snapshot, broadcast_rows):
        wanted = snapshot.filter(F.col("site") == run.site)
        layers = Layered(_known_to(layers.base, wanted, run, profile), layers.recent)
    return side_by_side(snapshot, layers, run, how)


def judged_rows(pairs: DataFrame, run: Run, profile: Profile, *keep: Column) -> DataFrame:
    """Rows in the shape that `emit_changes` reads, from the joined pairs, and `keep`."""
    seen = F.col("now").isNotNull()

    def pick(c: str) -> Column:
        return F.when(seen, F.col(f"now.{c}")).otherwise(F.col(f"old.{c}"))

    def before(c: str) -> Column:
        return F.when(seen, F.col(f"old.{c}"))

    run_ts, last = F.lit(run.run_ts), F.lit(run.last).cast("timestamp")
    gone = F.lit(None).cast("timestamp")
    if profile.gone_kind and run.error == 0:
        gone = F.when(~seen & (F.col("old.update_ts") >= last), run_ts)
    return pairs.select(
        F.lit(run.site).alias("site"),
        "item_id",
        run_ts.alias("run_ts"),
        last.alias("last_stable"),
        *[pick(c).alias(c) for c in (*TEXT_COLUMNS, *MEASURES, "end_ts")],
        *[before(c).alias(f"p_{c}") for c in MEASURES],
        before("update_ts").alias("p_ts"),
        *[F.col(f"old.{c}").alias(f"first_{c}") for c in TEXT_COLUMNS],
        (seen & last.isNotNull()).alias("judged"),
        gone.alias("gone_at"),
        *keep,
    )


def detect(
    snapshot: DataFrame,
    listing: DataFrame | Layered,
    run: Run,
    profile: Profile,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Changes of one run; writes nothing.

    Before the first clean run of a site nothing is reported.
    """
    snapshot = snapshot.filter((F.col("site") == run.site) & (F.col("run_ts") == F.lit(run.run_ts)))
    listing = layered(listing).map(lambda rows: rows.filter(F.col("site") == run.site))
    if run.last is None:
        snapshot, listing = snapshot.filter(F.lit(False)), listing.map(lambda rows: rows.filter(F.lit(False)))
    pairs = touched_pairs(snapshot, listing, run, profile, broadcast_rows)
    return emit_changes(judged_rows(pairs, run, profile), [profile])


# The single comparisons that `detect` fuses, for callers that need only one of them.
# Keys are never NULL (de-duplication drops those), so anti and semi joins are exact.


def first_seen(snapshot: DataFrame, listing: DataFrame) -> DataFrame:
    """Snapshot items that the listing has never held."""
    return snapshot.join(listing.select("site", "item_id"), ["site", "item_id"], "left_anti")


def already_known(snapshot: DataFrame, listing: DataFrame) -> DataFrame:
    """Snapshot items that the listing holds: the rows a merge updates."""
    return snapshot.join(listing.select("site", "item_id"), ["site", "item_id"], "left_semi")


def known_where(snapshot: DataFrame, listing: DataFrame, stored: Column) -> DataFrame:
    """Snapshot items whose stored row meets `stored`, e.g. unseen for a while."""
    return already_known(snapshot, listing.filter(stored))


def vanished(snapshot: DataFrame, listing: DataFrame, run: Run) -> DataFrame:
    """Listing rows seen since the last clean run that the snapshot lacks."""
    active = listing.filter(F.col("update_ts") >= F.lit(run.last))
    return active.join(snapshot.select("site", "item_id"), ["site", "item_id"], "left_anti")
