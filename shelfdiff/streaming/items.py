"""Change events per item from a stream of sightings, for rules that need no absence.

What is known of an item is its last sighting and its first texts. That state is a table: a
delta for each micro-batch, folded into a bucketed base, below a folder that all executors
share. A micro-batch looks up just its own items there, so an item that comes back after
years is known as it was: nothing expires, no executor holds state, and all work is joins
and windows. The profile's rules run as SQL, the same text as in batch. A site where absence
counts needs whole runs: see `shelfdiff.streaming.runs`.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfdiff.operators.backlog import sighting_rows
from shelfdiff.operators.merge import changes_of
from shelfdiff.profiles import Profile
from shelfdiff.schema import CHANGES, MEASURES, OBSERVATION
from shelfdiff.sources import layers as ly
from shelfdiff.sources.layered import LayeredTable
from shelfdiff.sources.tables import escaped

# A sighting knows the clean run before its own run: the log is complete when a run starts.
SIGHTING = T.StructType([*OBSERVATION, T.StructField("last_stable", T.TimestampType())])

SITES_AT_ONCE = 8


@dataclass(frozen=True)
class ItemStates:
    """State and changes below `root`. `buckets` is that of the bases and stays the same."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def states(self, site: str) -> LayeredTable:
        return LayeredTable(self.spark, f"{self.root}/states/{escaped(site)}", self.buckets)

    def changes(self) -> DataFrame:
        """The changes of all batches whose output is complete."""
        sites = ly.child_names(self.spark, f"{self.root}/changes")
        batches = [f"{self.root}/changes/{s}/{b}" for s in sites for b in ly.child_names(self.spark, f"{self.root}/changes/{s}")]
        done = [path for path in batches if ly.exists(self.spark, f"{path}/_SUCCESS")]
        if not done:
            return self.spark.createDataFrame([], CHANGES)
        return self.spark.read.schema(CHANGES).parquet(*done)

    def take(self, sightings: DataFrame, profiles: Iterable[Profile], mark: str) -> None:
        """Judge a batch of sightings and remember them, all sites at once. The same batch
        (`mark`) again writes what it wrote before."""
        profiles = list(profiles)
        rows = sightings.select(*SIGHTING.names).persist()
        try:
            with ThreadPoolExecutor(SITES_AT_ONCE) as pool:
                list(pool.map(lambda p: self._take_site(rows, p, mark), profiles))
        finally:
            rows.unpersist()

    def _take_site(self, rows: DataFrame, profile: Profile, mark: str) -> None:
        table = self.states(profile.site)
        found = ly.complete(self.spark, table.all())
        own = [x for x in found if x.kind == "delta" and x.mark == mark]
        if own:
            name, touched = own[0].last, table.read_deltas(own)
        else:
            newest = max((x.last for x in found), default="")
            name = f"{int(newest or 0) + 1:012d}"
            # Every measure is remembered as last seen, as over a history.
            whole = replace(profile, update_cols=(*MEASURES, "end_ts"), gone_kind=None)
            known = table.read(newest)
            touched = table.write_delta(sighting_rows(known, rows, whole), name, name, mark)
        out = f"{self.root}/changes/{escaped(profile.site)}/{mark}"
        changes_of(touched).hint("rebalance").write.mode("overwrite").parquet(out)
        table.fold(name)


def stream_items(
    sightings: DataFrame, states: ItemStates, profiles: Iterable[Profile], checkpoint: str
) -> StreamingQuery:
    """Start judging de-duplicated sightings (`SIGHTING` columns) from a stream, until all
    there are is taken; the changes are in `states.changes()`. A batch that is repeated
    after a failure counts once: it is known by the last part of `checkpoint` and its
    number."""
    profiles = list(profiles)
    name = escaped(checkpoint.rstrip("/").rsplit("/", 1)[-1]).replace("_", "-")
    return (
        sightings.writeStream.foreachBatch(
            lambda rows, batch: states.take(rows, profiles, f"{name}.{batch}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
