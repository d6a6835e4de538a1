"""Streams over the runs of `events`; they must give what the batch replay gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.detect_queries import ORACLES as DETECT
from checks.replay_queries import ORACLES as REPLAY
from shelfdiff import AUCTION, PRESENCE, STATUS, Profile, with_stable
from shelfdiff.plans.run import run_snapshot
from shelfdiff.schema import LISTING, RUN_LOG
from shelfdiff.session import scratch_path, settle
from shelfdiff.sources.tables import Store
from shelfdiff.streaming.closings import stream_closings
from shelfdiff.streaming.items import SIGHTING, ItemStates, stream_items
from shelfdiff.streaming.runs import ARRIVAL, stream_runs

A, B, C = fx.A, fx.B, fx.C
PRESENCE_COLUMNS = [
    "site", "run_ts", "kind", "item_id", "title", "item_url", "image_url", "old_price", "new_price"
]


PROFILE_OF = {A: PRESENCE, B: STATUS, C: AUCTION}
HALF = "2024-01-16 00:00:00"


def committed_runs(spark: SparkSession, sf_dir: str, sites: tuple[str, ...], fine: bool = False) -> Store:
    """Land all snapshots, and announce the runs of some sites in two waves, between which
    the stream is stopped and resumed."""
    store = Store(spark, scratch_path(spark, "store"))
    arrivals, progress = scratch_path(spark, "arrivals"), scratch_path(spark, "progress")
    store.write_snapshot(fx.snapshots(spark, sf_dir, sites, fine))
    runs = fx.runs(spark, sf_dir, sites).select(*ARRIVAL.names)
    half = F.lit(HALF).cast("timestamp")
    for wave in (F.col("run_ts") < half, F.col("run_ts") >= half):
        runs.filter(wave).coalesce(1).write.mode("append").parquet(arrivals)
        source = spark.readStream.schema(ARRIVAL).parquet(arrivals)
        stream_runs(source, store, {s: PROFILE_OF[s] for s in sites}, progress).awaitTermination()
    return store


def _runs(site: str):
    """The run log that committing run by run leaves."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fx.plain(committed_runs(spark, sf_dir, (site,)).run_log().select(*RUN_LOG.names))

    return query


def change_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes that the same commits keep, as far as this kind of site has them: bids
    and closing times are none of its columns, and a merge leaves them as first stored."""
    return fx.plain(committed_runs(spark, sf_dir, (A,)).changes()).select(*PRESENCE_COLUMNS)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which batch of the stream brought each run; all sites come in the same batches."""
    store = committed_runs(spark, sf_dir, fx.SITES)
    number = F.substring_index("batch", "/", -1).cast("int").alias("batch_no")
    return fx.plain(store.batches().select("site", "run_ts", number))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of all sites after all commits, out of bases and deltas."""
    store = committed_runs(spark, sf_dir, fx.SITES, fine=True)
    out = None
    for site in fx.SITES:
        own = store.listing(site).select(*LISTING.names)
        out = own if out is None else out.unionByName(own)
    return fx.plain(out)


def _commit(profile: Profile):
    """The listing after the newest clean run was committed on the state before it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run, snapshot, before = fx.run_and_state(spark, sf_dir, profile)
        store = Store(spark, scratch_path(spark, "store"))
        store.write_version(before, profile.site, run.last)
        earlier = fx.runs(spark, sf_dir, (profile.site,)).filter(F.col("run_ts") <= F.lit(run.last))
        store.append_log(earlier)
        run_snapshot(store, snapshot, profile, store.open_run(profile.site, run.run_ts), commit=True)
        return fx.plain(store.listing(profile.site).select(*LISTING.names))

    return query


def find_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item, looked up in base and deltas."""
    store = committed_runs(spark, sf_dir, (A,))
    store.fold(A, base=True)
    return fx.plain(store.find_item(A, "7").select("item_id", "title", "price", "update_ts"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and auction changes, with the stream stopped and resumed halfway."""
    source, progress = scratch_path(spark, "sightings"), scratch_path(spark, "progress")
    states = ItemStates(spark, scratch_path(spark, "items"), buckets=8)
    log = with_stable(fx.runs(spark, sf_dir, (B, C)))
    log = log.select("site", "run_ts", "last_stable")
    seen = fx.snapshots(spark, sf_dir, (B, C)).join(log, ["site", "run_ts"])
    landed = settle(seen.select(*SIGHTING.names), "landed")
    half = F.lit(HALF).cast("timestamp")
    for wave in (F.col("run_ts") < half, F.col("run_ts") >= half):
        landed.filter(wave).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SIGHTING).parquet(source)
        stream_items(stream, states, (STATUS, AUCTION), progress).awaitTermination()
    return fx.plain(states.changes())


# A run that comes after later ones, but within the watermark's delay.
LATE_RUN, DELAY_DAYS = "2024-01-13 00:00:00", 3


def closings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Auctions that ended, with one run coming late and the stream stopped and resumed."""
    source, out, progress = (scratch_path(spark, x) for x in ("sightings", "closings", "progress"))
    landed = settle(fx.snapshots(spark, sf_dir, (C,), fine=True), "landed")
    half, late = (F.lit(x).cast("timestamp") for x in (HALF, LATE_RUN))
    early = (F.col("run_ts") < half) & (F.col("run_ts") != late)
    for wave in (early, ~early):
        landed.filter(wave).write.mode("append").parquet(source)
        stream = spark.readStream.schema(landed.schema).parquet(source)
        (
            stream_closings(stream, f"{DELAY_DAYS} days")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    found = spark.read.parquet(out)
    return fx.plain(found.select("item_id", "run_ts", "title", "price", "bid_num", "end_ts", "ended"))


QUERIES = {
    "stream_ended": closings,
    "stream_runs": _runs(A),
    "stream_runs_b": _runs(B),
    "stream_runs_c": _runs(C),
    "stream_batches": batches,
    "stream_listing": listing,
    "commit_a": _commit(PRESENCE),
    "commit_b": _commit(STATUS),
    "commit_c": _commit(AUCTION),
    "find_stored": find_stored,
    "changes_table": change_table,
    "stream_changes": items,
}

ORACLES = {
    "stream_ended": fx.plain_sql(
        "with " + fx.views(fine=True) + " select item_id, " + fx.time_text("run_ts")
        + ", title, price, bid_num, " + fx.time_text("end_ts") + ", true as ended from seq"
        " where (n_ts is null or n_ts > end_ts)"
        f" and end_ts < (select max(run_ts) from runs) - interval {DELAY_DAYS} day",
        "bid_num",
    ),
    "stream_runs": f"select * from ({REPLAY['run_log']}) where site = '{A}'",
    "stream_runs_b": f"select * from ({REPLAY['run_log']}) where site = '{B}'",
    "stream_runs_c": f"select * from ({REPLAY['run_log']}) where site = '{C}'",
    "stream_batches": "with " + fx.views() + " select s.site, " + fx.time_text("run_ts")
    + f", cast(case when run_ts < timestamp '{HALF}' then 0 else 1 end as int) as batch_no"
    + f" from runs, (select unnest({list(fx.SITES)}) as site) s",
    "stream_listing": DETECT["listing_state"],
    "commit_a": DETECT["merge_a"],
    "commit_b": DETECT["merge_b"],
    "commit_c": DETECT["merge_c"],
    "find_stored": "with " + fx.views() + ", every as (select *, row_number() over (partition by item_id"
    " order by run_ts) as up, row_number() over (partition by item_id order by run_ts desc) as down from obs)"
    " select item_id, a.title as title, z.price as price, " + fx.time_text("z.run_ts", "update_ts")
    + " from every a join every z using (item_id) where a.up = 1 and z.down = 1 and item_id = '7'",
    "changes_table": f"select {', '.join(PRESENCE_COLUMNS)} from ({REPLAY['changes_all']}) where site = '{A}'",
    "stream_changes": f"select * from ({REPLAY['changes_all']}) where site <> '{A}'",
}
