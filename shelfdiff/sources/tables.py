"""The listing, snapshots and the run log on plain parquet.

Layout below one root folder:

    listing/<site>/base_*     a complete listing as of a run, bucketed and sorted by item
    listing/<site>/delta_*    the rows that a run, or each run of a backlog, has touched
    listing/<site>/fold_*     the newest rows of the deltas of a span of runs
    snapshots/site=/run_ts=   de-duplicated snapshots, overwritten per run
    changes/site=/run_ts=     the changes that each commit found, kept when versions expire
    rules                     exclusion rules, replaced as a whole
    run_log/<site>/log_*      log rows of a run or a span of runs; a run's is written last
    skipped                   announced runs that came too late or from unknown sites
    layout                    the number of buckets of bases and snapshots

A commit writes as many rows as its snapshot has, whatever the size of the listing: see
`shelfdiff.sources.layered`.

The names of log layers tell the newest run and the newest clean run of a site: opening a
run reads no file at all. A run counts once its log row is there. Runs of a site are
committed in order, so a delta newer than the log is an unfinished commit: it is never
read, and the next commit removes it. Losing the driver or an executor halfway leaves the
last committed state in force. One writer at a time is assumed for each site.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfdiff.functions.times import as_utc, from_micros, micros
from shelfdiff.operators.detect import Layered, Run, open_run
from shelfdiff.schema import CHANGES, LISTING, OBSERVATION, RULES, RUN_LOG, table_schema
from shelfdiff.session import settle
from shelfdiff.sources import layered as rows_of
from shelfdiff.sources import layers as ly
from shelfdiff.sources.layered import LayeredTable, bucketed_ddl
from shelfdiff.sources.layers import NO_MARK, new_layer, version_name, version_time


# Buckets of a new store for each core that works on it.
BUCKETS_PER_CORE = 2


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at `path`, or an empty one where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_ready(spark: SparkSession, path: str) -> bool:
    """The table exists and holds at least one row."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def find_id(
    listing: DataFrame, item_id, column: str = "item_id", site: str | None = None
) -> DataFrame:
    """The row of one item, of one site if it is named, or none. The id takes the column's
    type, so that the filter reaches the scan's row-group statistics; an id that cannot
    have that type is not there."""
    wanted = F.lit(item_id).try_cast(listing.schema[column].dataType)
    found = listing.filter(F.col(column) == wanted)
    if site is not None:
        found = found.filter(F.col("site") == site)
    return found.limit(1)


@dataclass(frozen=True)
class Head:
    """What the log says about a site: its newest run and its newest clean run."""

    newest: datetime | None = None
    clean: datetime | None = None


@dataclass(frozen=True)
class Store:
    """All tables below `root`. `new_buckets` counts when the store is new, later the
    number it was made with stays. Without it there are `BUCKETS_PER_CORE` for each core of
    the cluster, or as many as the session's shuffle partitions if these are fewer: every
    run of every site has a file per bucket, so that more partitions for larger inputs
    would mean more files of the same size."""

    spark: SparkSession
    root: str
    new_buckets: int | None = None

    @property
    def snapshot_path(self) -> str:
        return f"{self.root}/snapshots"

    def _log_folder(self, site: str) -> str:
        return f"{self.root}/run_log/{escaped(site)}"

    @cached_property
    def buckets(self) -> int:
        path, schema = f"{self.root}/layout", T.StructType([T.StructField("buckets", T.IntegerType())])
        known = _read(self.spark, path, schema).first()
        if known is not None:
            return known["buckets"]
        most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = self.new_buckets or min(most, BUCKETS_PER_CORE * self.spark.sparkContext.defaultParallelism)
        self.spark.createDataFrame([(wanted,)], schema).coalesce(1).write.parquet(path)
        return wanted

    # Run log.

    def run_log(self) -> DataFrame:
        """All log rows: a few files per site, whatever the number of runs."""
        return self._logged().select(*RUN_LOG.names)

    def batches(self) -> DataFrame:
        """Which batch of which stream brought a run: site, run_ts, batch."""
        return self._logged().select(*RUN_KEYS, "batch").filter("batch is not null")

    def _logged(self) -> DataFrame:
        paths = []
        for name in ly.child_names(self.spark, f"{self.root}/run_log"):
            found = ly.all_layers(self.spark, f"{self.root}/run_log/{name}")
            paths += [x.path for x in ly.widest(ly.complete(self.spark, found))]
        if not paths:
            return self.spark.createDataFrame([], LOGGED)
        return self.spark.read.schema(LOGGED).parquet(*paths)

    def head(self, site: str) -> Head:
        """The newest runs of a site, from the names of its log layers alone."""
        found = ly.complete(self.spark, ly.all_layers(self.spark, self._log_folder(site)))
        newest = ly.newest_layer(found)
        if newest is None:
            return Head()
        return Head(version_time(newest.last), version_time(newest.mark))

    def open_run(self, site: str, run_ts: datetime, error: int = 0) -> Run:
        """A run as its site's log stands. Only a run that is no newer than the log needs
        its rows read."""
        run_ts, head = as_utc(run_ts), self.head(site)
        if head.newest is None or run_ts > head.newest:
            return Run(site, run_ts, error, head.clean, head.newest)
        return open_run(self.run_log(), site, run_ts, error)

    def append_log(self, rows: DataFrame, run: Run | None = None) -> None:
        """Add the log row of `run`, or without it any rows. Each site gets a layer."""
        columns = [F.col(f.name).cast(f.dataType) for f in RUN_LOG]
        rows = rows.select(*columns)
        if run is not None:
            clean = run.run_ts if run.error == 0 else run.last
            self.write_log(rows, run.site, run.run_ts, run.run_ts, clean)
            return
        rows = settle(rows, "log-rows")
        us, no_error = micros(F.col("run_ts")), F.col("error") == 0
        spans = rows.groupBy("site").agg(
            F.min(us).alias("first"), F.max(us).alias("last"), F.max(F.when(no_error, us)).alias("clean")
        )
        # One row for each site.
        for x in spans.collect():
            known = [t for t in (from_micros(x["clean"]), self.head(x["site"]).clean) if t]
            own = rows.filter(F.col("site") == x["site"])
            self.write_log(own, x["site"], from_micros(x["first"]), from_micros(x["last"]), max(known, default=None))

    def write_log(
        self,
        rows: DataFrame,
        site: str,
        first: datetime,
        last: datetime,
        clean: datetime | None,
        batch: str | None = None,
    ) -> None:
        """Add a layer of log rows of one site: its runs first..last, the newest clean run
        as of the last, and the batch of a stream that brought them."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG]
        rows = rows.select(*columns, F.lit(batch).cast("string").alias("batch"))
        folder = self._log_folder(site)
        mark = version_name(clean) if clean else NO_MARK
        old = ly.all_layers(self.spark, folder)
        layer = new_layer(folder, "log", version_name(first), version_name(last), mark)
        rows.coalesce(1).write.parquet(layer.path)
        kept = ly.widest([*ly.complete(self.spark, old), layer])
        if len(kept) < rows_of.FOLD:
            return
        # What earlier folds have replaced goes now; what this one replaces stays for
        # readers that have begun.
        ly.remove(self.spark, [x for x in old if x not in kept])
        whole = new_layer(folder, "log", kept[0].first, kept[-1].last, kept[-1].mark)
        known = self.spark.read.schema(LOGGED).parquet(*[x.path for x in kept])
        known.hint("rebalance").write.parquet(whole.path)

    def skipped(self) -> DataFrame:
        """Announced runs that were not committed, and why."""
        return _read(self.spark, f"{self.root}/skipped", SKIPPED).distinct()

    def append_skipped(self, runs: Iterable[tuple[str, datetime, str]]) -> None:
        """Note runs (site, time, reason) that were not committed."""
        rows = self.spark.createDataFrame(list(runs), SKIPPED)
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/skipped")

    # Snapshots.

    def write_snapshot(
        self, snapshot: DataFrame, runs: Iterable[tuple[str, datetime]] = ()
    ) -> None:
        """Replace the partitions of the runs in `snapshot`, leave all others. Runs named in
        `runs` have landed even if the snapshot has no rows of them: they become empty.

        Files are bucketed by item, so that a replay of the history needs no shuffle.
        """
        columns = [*(c for c in OBSERVATION.names if c not in RUN_KEYS), *RUN_KEYS]
        for site, run_ts in runs:
            of_run = (F.col("site") == site) & (F.col("run_ts") == F.lit(run_ts))
            if snapshot.filter(of_run).isEmpty():
                self._clear_snapshot(site, run_ts)
        (
            snapshot.select(*columns)
            .repartition(self.buckets, "item_id")
            .write.mode("overwrite")
            .insertInto(self._snapshot_table())
        )

    def _clear_snapshot(self, site: str, run_ts: datetime) -> None:
        """Leave an empty partition, whatever it held."""
        name = self._snapshot_table()
        args = {"site": site, "run_ts": _run_text(run_ts)}
        spec = "(site = '{}', run_ts = '{}')".format(*(_quoted(v) for v in args.values()))
        nothing = ", ".join(
            f"cast(null as {f.dataType.simpleString()})" for f in OBSERVATION if f.name not in RUN_KEYS
        )
        self.spark.sql(f"insert overwrite table {name} partition {spec} select {nothing} where false")
        # Adding a partition makes its folder, which tells that the run has landed.
        self.spark.sql(f"alter table {name} drop if exists partition {spec}")
        self.spark.sql(f"alter table {name} add partition {spec}")

    def snapshots(self) -> DataFrame:
        """All landed snapshots, bucketed by item."""
        name = self._snapshot_table()
        self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name).select(*OBSERVATION.names)

    def _snapshot_table(self) -> str:
        """The folder's name in the catalog: one per store, as plans look partitions up
        when they run."""
        name = f"shelfdiff_snapshots_{hashlib.md5(self.snapshot_path.encode()).hexdigest()}"
        ddl = bucketed_ddl(OBSERVATION, self.buckets, self.snapshot_path, RUN_KEYS)
        self.spark.sql(f"create table if not exists {name} {ddl}")
        return name

    def _run_folder(self, table: str, site: str, run_ts: datetime) -> str:
        return f"{table}/site={escaped(site)}/run_ts={escaped(_run_text(run_ts))}"

    def landed(self, site: str, run_ts: datetime) -> bool:
        """Whether a snapshot of this run was written, be it empty."""
        return ly.exists(self.spark, self._run_folder(self.snapshot_path, site, run_ts))

    def snapshots_of(self, site: str, runs: Iterable[datetime]) -> DataFrame:
        """The snapshots of some runs, read from their own folders; runs that have not
        landed are left out."""
        paths = [self._run_folder(self.snapshot_path, site, ts) for ts in runs if self.landed(site, ts)]
        if not paths:
            return self.spark.createDataFrame([], OBSERVATION)
        reader = self.spark.read.schema(OBSERVATION).option("basePath", self.snapshot_path)
        return reader.parquet(*paths).select(*OBSERVATION.names)

    def snapshot(self, site: str, run_ts: datetime) -> DataFrame:
        """One run's snapshot, read from its own folder whatever the length of history."""
        return self._of_run(self.snapshot_path, OBSERVATION, site, run_ts)

    def _of_run(
        self, table: str, schema: T.StructType, site: str, run_ts: datetime
    ) -> DataFrame:
        stored = T.StructType([f for f in schema if f.name not in RUN_KEYS])
        rows = _read(self.spark, self._run_folder(table, site, run_ts), stored)
        keys = {"site": F.lit(site), "run_ts": F.lit(run_ts)}
        return rows.withColumns(keys).select(*schema.names)

    # Changes.

    @property
    def change_path(self) -> str:
        return f"{self.root}/changes"

    def write_changes(self, changes: DataFrame, site: str, run_ts: datetime) -> DataFrame:
        """Write what a run's commit found, in place of an unfinished attempt's, and return
        it as read back. Unlike the versions they come from, changes never expire."""
        rows = changes.drop(*RUN_KEYS)
        rows.write.mode("overwrite").parquet(self._run_folder(self.change_path, site, run_ts))
        return self.changes_of(site, run_ts)

    def write_changes_of(self, changes: DataFrame, site: str, runs: Iterable[datetime]) -> None:
        """The same for several runs of a site in one job. What an unfinished attempt left
        of runs that have no changes now goes too."""
        ly.remove_paths(self.spark, [self._run_folder(self.change_path, site, ts) for ts in runs])
        # Below the site's own folder: other sites are written at the same time.
        rows = changes.drop("site").hint("rebalance", "run_ts").write.partitionBy("run_ts")
        rows.mode("append").parquet(f"{self.change_path}/site={escaped(site)}")

    def changes_of(self, site: str, run_ts: datetime) -> DataFrame:
        return self._of_run(self.change_path, CHANGES, site, run_ts)

    def changes(self) -> DataFrame:
        """The changes of all committed runs."""
        found = _read(self.spark, self.change_path, CHANGES).select(*CHANGES.names)
        logged = self.run_log().select(*RUN_KEYS).distinct()
        return found.join(logged, list(RUN_KEYS), "left_semi")

    # Exclusion rules.

    def rules(self) -> DataFrame:
        return _read(self.spark, f"{self.root}/rules", RULES)

    def save_rules(self, rules: DataFrame) -> DataFrame:
        """Replace the stored rules and return them. The new table may be made of the old
        one: it is worked out before that goes."""
        fixed = settle(rules.select(*RULES.names), "rules")
        fixed.write.mode("overwrite").parquet(f"{self.root}/rules")
        return self.rules()

    # The listing.

    def _listing(self, site: str) -> LayeredTable:
        return LayeredTable(self.spark, f"{self.root}/listing/{escaped(site)}", self.buckets)

    def listing(self, site: str, newest: datetime | None = None) -> DataFrame:
        """A site's listing as of its newest committed run, clean or not; pass `newest` if
        it is known already."""
        return self.layered(site, newest).whole()

    def layered(self, site: str, newest: datetime | None = None) -> Layered:
        """The same as a base and the rows that later runs have touched: what is joined to
        it item by item then leaves the base where it is."""
        newest = newest or self.head(site).newest
        if newest is None:
            return Layered(self.spark.createDataFrame([], LISTING))
        # Of a delta of several runs only those up to this one count.
        upto = F.coalesce(F.col("update_ts") <= F.lit(newest), F.lit(True))
        return self._listing(site).read(version_name(newest), upto)

    def version(self, site: str, run_ts: datetime) -> DataFrame:
        """The listing as of an earlier run; empty if that has expired."""
        return self.layered(site, run_ts).whole()

    def find_item(self, site: str, item_id: str) -> DataFrame:
        """One item's row, or none: of the base one bucket is read, of the deltas those row
        groups whose bloom filters have the id."""
        return self.layered(site).map(lambda rows: rows.filter(F.col("item_id") == F.lit(item_id))).whole()

    def write_version(self, version: DataFrame, site: str, run_ts: datetime) -> DataFrame:
        """Write a complete listing as of a run and return it as read back."""
        return self._listing(site).write_base(version, version_name(run_ts))

    def write_delta(
        self, rows: DataFrame, site: str, first: datetime, last: datetime | None = None
    ) -> DataFrame:
        """Write the rows that the runs first..last touch, one per item and run, with the
        changes they stand for, and return them as read back. What an unfinished commit
        left is removed first."""
        newest = self.head(site).newest
        self._listing(site).drop_after(version_name(newest) if newest else "")
        return self._listing(site).write_delta(rows, version_name(first), version_name(last or first))

    def fold(self, site: str, base: bool | None = None) -> str | None:
        """Fold a site's deltas if there are many, or anyway: see `LayeredTable.fold`."""
        newest = self.head(site).newest
        return self._listing(site).fold(version_name(newest), base) if newest else None

    def expire(self, site: str, keep: int = 3, since: datetime | None = None) -> int:
        """Remove what only listings older than the newest `keep` runs need; returns how
        many runs that were. `since` spares counting runs that an earlier call has dealt
        with. The changes that those runs found stay."""
        if keep < 1:
            raise ValueError("the newest version is the listing itself")
        runs = self.run_log().filter(F.col("site") == site).select("run_ts")
        kept = runs.orderBy(F.desc("run_ts")).limit(keep)
        oldest = from_micros(kept.agg(micros(F.min("run_ts"))).first()[0])
        if oldest is None:
            return 0
        old = runs.filter(F.col("run_ts") < F.lit(oldest))
        if since is not None:
            old = old.filter(F.col("run_ts") >= F.lit(since))
        n = old.count()
        if n:
            after = runs.filter(F.col("run_ts") > F.lit(oldest)).agg(micros(F.min("run_ts")))
            first = from_micros(after.first()[0])
            kept_rows = F.coalesce(F.col("update_ts") > F.lit(oldest), F.lit(False))
            self._listing(site).forget(version_name(oldest), kept_rows, first and version_name(first))
        return n


RUN_KEYS = ("site", "run_ts")
LOGGED = T.StructType([*RUN_LOG, T.StructField("batch", T.StringType())])
SKIPPED = table_schema("site string, run_ts timestamp, reason string")


def _run_text(run_ts: datetime) -> str:
    """A run's time as Spark writes it in a UTC session."""
    utc = as_utc(run_ts)
    text = utc.strftime("%Y-%m-%d %H:%M:%S")
    if utc.microsecond:
        text += f".{utc.microsecond:06d}".rstrip("0")
    return text


# Characters that Spark escapes in the names of partition folders.
ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


def escaped(value: str) -> str:
    """A partition value as it stands in the name of its folder."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def _quoted(value: str) -> str:
    """Inside a quoted SQL text."""
    return value.replace("\\", "\\\\").replace("'", "\\'")
