"""A keyed table of items as a base and deltas.

A commit writes the rows it touches and no others: a delta. The table is the newest base
with the newest row of each item of the deltas since. Deltas are folded into one when there
are `FOLD` of them, and into a new base when they hold a fair share of its rows, so reading
stays cheap and each row is rewritten seldom. A base is bucketed and sorted by item: joins
by item leave it where it is, and a lookup reads one bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff.operators.detect import Layered
from shelfdiff.schema import CHANGES, LISTING
from shelfdiff.sources import layers as ly
from shelfdiff.sources.layers import NO_MARK, Layer, new_layer

# Deltas or log layers before they are folded into one.
FOLD = 16
# A new base is written when deltas hold one row for so many of the base.
BASE_SHARE = 4

# Rows of a delta, with the changes they stand for.
TOUCHED = T.StructType([*LISTING, T.StructField("found", T.ArrayType(CHANGES))])


def bucketed_ddl(
    schema: T.StructType, buckets: int, path: str, partitions: tuple[str, ...] = ()
) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    split = f"partitioned by ({', '.join(partitions)})" if partitions else ""
    # An insert replaces the partitions it has rows for. This must be a table option:
    # the writer's own options do not reach an insert.
    split = f"options (partitionOverwriteMode 'dynamic') {split}" if partitions else ""
    return (
        f"({columns}) using parquet {split} clustered by (item_id) sorted by (item_id)"
        f" into {buckets} buckets location '{path}'"
    )


def newest_rows(deltas: DataFrame) -> DataFrame:
    """The newest row of each item. A run's row of an item it has not seen, but reports as
    gone, is that of the last sighting: equal times have equal rows."""
    rest = [c for c in LISTING.names if c != "item_id"]
    newest = deltas.groupBy("item_id").agg(F.max_by(F.struct(*rest), "update_ts").alias("_newest"))
    return newest.select(*[F.col("item_id") if c == "item_id" else F.col(f"_newest.{c}") for c in LISTING.names])


@dataclass(frozen=True)
class LayeredTable:
    """One site's rows below `folder`. Commits are named by texts that sort in their order."""

    spark: SparkSession
    folder: str
    buckets: int

    def all(self) -> list[Layer]:
        return ly.all_layers(self.spark, self.folder)

    def parts(self, upto: str) -> tuple[Layer | None, list[Layer]]:
        """The base and the deltas that make up the table as of a commit. A delta that was
        written by several commits serves each of them; a folded one has but the last rows."""
        found = self.all()
        bases = [x for x in found if x.kind == "base" and x.last <= upto]
        base = ly.newest_layer(ly.complete(self.spark, bases))
        since = [x for x in found if base is None or x.last > base.last]
        deltas = [x for x in since if x.kind == "delta" and x.first <= upto]
        folded = [x for x in since if x.kind == "fold" and x.last <= upto and (base is None or x.first > base.last)]
        return base, ly.widest(ly.complete(self.spark, [*deltas, *folded]))

    def read(self, upto: str, counts: Column | None = None) -> Layered:
        """The table as of a commit; `counts` tells which rows of the deltas count."""
        base, deltas = self.parts(upto)
        whole = self.read_base(base) if base else self.spark.createDataFrame([], LISTING)
        if not deltas:
            return Layered(whole)
        rows = self.read_deltas(deltas)
        return Layered(whole, newest_rows(rows if counts is None else rows.filter(counts)))

    def read_base(self, base: Layer) -> DataFrame:
        with self._registered(base.path) as name:
            return self.spark.table(name).select(*LISTING.names)

    def read_deltas(self, deltas: list[Layer]) -> DataFrame:
        return self.spark.read.schema(TOUCHED).parquet(*[x.path for x in deltas])

    def write_base(self, rows: DataFrame, name: str) -> DataFrame:
        layer = new_layer(self.folder, "base", name, name)
        with self._registered(layer.path) as table:
            rows.select(*LISTING.names).write.mode("overwrite").insertInto(table)
            return self.spark.table(table)

    def write_delta(self, rows: DataFrame, first: str, last: str, mark: str = NO_MARK) -> DataFrame:
        layer = new_layer(self.folder, "delta", first, last, mark)
        self._write(rows.select(*TOUCHED.names), layer)
        return self.read_deltas([layer])

    def drop_after(self, name: str) -> None:
        """Remove what is newer than a commit: left by one that was not finished."""
        ly.remove(self.spark, [x for x in self.all() if x.last > name])

    def fold(self, upto: str, base: bool | None = None) -> str | None:
        """Fold the deltas into one, or into a new base if they hold a fair share of its
        rows; `base` tells which to do anyway. Returns the kind of the new layer."""
        old, deltas = self.parts(upto)
        if not deltas or base is None and len(deltas) < FOLD:
            return None
        rows = self.read_deltas(deltas)
        if base is None:
            # Counts come from the footers of the files.
            base = old is None or rows.count() * BASE_SHARE >= self.read_base(old).count()
        if base:
            self.write_base(self.read(upto).whole(aligned=True), upto)
            return "base"
        found = F.lit(None).cast(TOUCHED["found"].dataType).alias("found")
        layer = new_layer(self.folder, "fold", deltas[0].first, deltas[-1].last)
        self._write(newest_rows(rows).select("*", found), layer)
        return "fold"

    def forget(self, name: str, kept: Column, first_kept: str | None) -> None:
        """Write a base as of a commit, if there is none, and remove what only older states
        need. Of a delta that goes on beyond it the rows that are `kept` stay."""
        base, _ = self.parts(name)
        if base is None or base.last != name:
            self.write_base(self.read(name, ~kept).whole(aligned=True), name)
        found = self.all()
        for x in found:
            if x.kind == "delta" and x.first <= name < x.last:
                layer = new_layer(self.folder, "delta", first_kept, x.last)
                self._write(self.read_deltas([x]).filter(kept), layer)
        gone = [x for x in found if x.last < name or x.kind != "base" and x.first <= name]
        ly.remove(self.spark, gone)

    def _write(self, rows: DataFrame, layer: Layer) -> None:
        """Files by bytes, not by shuffle partitions, with bloom filters on the item."""
        whole = rows.hint("rebalance").sortWithinPartitions("item_id")
        whole.write.option("parquet.bloom.filter.enabled#item_id", "true").parquet(layer.path)

    @contextmanager
    def _registered(self, path: str) -> Iterator[str]:
        """A name in the catalog while a plan is built on a base, as Spark knows
        bucketing through the catalog only. Dropping the name of an external table leaves
        its files, and plans made meanwhile keep them."""
        name = f"shelfdiff_base_{uuid.uuid4().hex}"
        self.spark.sql(f"create table {name} {bucketed_ddl(LISTING, self.buckets, path)}")
        try:
            yield name
        finally:
            self.spark.sql(f"drop table {name}")
