"""Runs as a stream: every announced run is diffed, merged and logged once."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfdiff.functions.times import from_micros, micros
from shelfdiff.plans.run import commit_runs
from shelfdiff.profiles import Profile
from shelfdiff.schema import table_schema
from shelfdiff.sources.tables import Store

# Announces that a run's snapshot partition is complete.
ARRIVAL = table_schema("site string, run_ts timestamp, error bigint, page bigint, count bigint")

# Sites whose commits run at the same time.
SITES_AT_ONCE = 8


def commit_arrivals(
    arrivals: DataFrame, store: Store, profiles: Mapping[str, Profile], batch: str | None = None
) -> None:
    """Commit the announced runs: all runs of a site in one pass, all sites at once. The
    driver sees the announcements only, a row per run.

    A run that is no newer than the log is skipped: a late one would rewrite the past, and
    a batch that is retried after a failure must not commit a run twice. Late runs, and
    those of unknown sites, are written to the store's table of skipped runs.

    A run whose snapshot is not there stops the stream, unless it was announced with exactly
    no items: taken as empty, it would report all items as sold. Runs of its site before it,
    and those of other sites, are committed first. `batch` is kept in the log.
    """
    ordered = arrivals.withColumn("run_us", micros(F.col("run_ts"))).orderBy("run_us", "site")
    by_site: dict[str, dict[int, Row]] = {}
    for row in ordered.toLocalIterator():
        by_site.setdefault(row["site"], {}).setdefault(row["run_us"], row)
    errors: list[str] = []
    skipped: list[tuple[str, datetime, str]] = []
    with ThreadPoolExecutor(SITES_AT_ONCE) as pool:
        work = [
            pool.submit(_commit_site, store, profiles.get(site), site, list(rows.values()), batch)
            for site, rows in by_site.items()
        ]
    for job in work:
        wrong, left_out = job.result()
        errors += wrong
        skipped += left_out
    if skipped:
        store.append_skipped(skipped)
    if errors:
        raise ValueError("; ".join(errors))


def _commit_site(
    store: Store, profile: Profile | None, site: str, rows: list[Row], batch: str | None
) -> tuple[list[str], list[tuple[str, datetime, str]]]:
    """Commit what can be committed. Returns what stops the rest, and what was skipped."""
    times = [from_micros(row["run_us"]) for row in rows]
    if profile is None:
        return [], [(site, ts, "unknown site") for ts in times]
    newest = store.head(site).newest
    late = [ts for ts in times if newest is not None and ts <= newest]
    skipped = []
    if late:
        own = store.run_log().filter(F.col("site") == site).select(micros(F.col("run_ts")).alias("us"))
        known = {x["us"] for x in own.filter(F.col("us").isin([r["run_us"] for r in rows])).toLocalIterator()}
        skipped = [(site, ts, "late") for ts, x in zip(late, rows, strict=False) if x["run_us"] not in known]
    ready: list[dict[str, object]] = []
    wrong: list[str] = []
    for ts, row in list(zip(times, rows, strict=True))[len(late) :]:
        if row["count"] != 0 and not store.landed(site, ts):
            n = "an unknown number of" if row["count"] is None else row["count"]
            wrong.append(f"{site}: run {ts} has {n} items, but no snapshot has landed")
            break
        ready.append({**row.asDict(), "run_ts": ts})
    if ready:
        commit_runs(store, profile, ready, batch)
    return wrong, skipped


def stream_runs(
    arrivals: DataFrame, store: Store, profiles: Mapping[str, Profile], checkpoint: str
) -> StreamingQuery:
    """Start committing runs from a stream of arrivals, until all there are is taken. The
    log keeps the stream's name (the last part of `checkpoint`) and the batch of each run."""
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]
    return (
        arrivals.writeStream.foreachBatch(
            lambda rows, batch: commit_arrivals(rows, store, profiles, f"{name}/{batch}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
