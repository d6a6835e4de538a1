"""One run end to end: parse, de-duplicate, filter, diff, and on request commit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.functions.times import as_utc, from_micros, micros
from shelfdiff.operators.backlog import BACKLOG_RUNS, backlog_rows
from shelfdiff.operators.dedup import dedup_first
from shelfdiff.operators.detect import Run, detect
from shelfdiff.operators.digest import cut_lines, digest, digest_lines
from shelfdiff.operators.merge import changes_of, touched_rows
from shelfdiff.operators.rules import apply_rules
from shelfdiff.operators.runlog import one_run_summary, run_summary
from shelfdiff.profiles import PROFILES, Profile
from shelfdiff.schema import OBSERVATION, RUN_LOG
from shelfdiff.session import settle, use_utc
from shelfdiff.sources.payloads import observations_of, page_totals, parse_pages, quarantine_of
from shelfdiff.sources.tables import Store


@dataclass(frozen=True)
class RunResult:
    run: Run
    changes: DataFrame
    summary: DataFrame
    quarantine: DataFrame | None = None
    # how many items the exclusion rules removed, one row (hits)
    removed: DataFrame | None = None

    def digest(self, profile: Profile) -> DataFrame:
        return digest(self.changes, self.summary, [profile])


def run_snapshot(
    store: Store,
    snapshot: DataFrame,
    profile: Profile,
    run: Run,
    page: int = 0,
    count: int = 0,
    commit: bool = False,
) -> RunResult:
    """Diff a run's de-duplicated snapshot against the store.

    With `commit`, the rows that the run touches are written with their changes first, the
    changes come from what was written, and the log row is appended last; then deltas are
    folded if there are many. In a preview the changes are worked out once into the shared
    folder, as summary and digest both read them.
    """
    listing = store.layered(run.site, run.newest)
    if commit:
        touched = touched_rows(listing, snapshot, run, profile)
        found = changes_of(store.write_delta(touched, run.site, run.run_ts))
        changes = store.write_changes(found, run.site, run.run_ts)
    else:
        changes = settle(detect(snapshot, listing, run, profile), f"changes-{run.site}")
    totals = {
        "site": run.site,
        "run_ts": run.run_ts,
        "error": run.error,
        "page": page,
        "count": count,
    }
    summary = one_run_summary(changes, totals)
    if commit:
        store.append_log(summary, run)
        store.fold(run.site)
    return RunResult(run, changes, summary)


def commit_runs(
    store: Store,
    profile: Profile,
    announced: Sequence[Mapping[str, object]],
    batch: str | None = None,
) -> None:
    """Commit several landed runs of one site, all newer than its log, in a fixed number of
    jobs: the rows they touch, their changes, their log rows.

    `announced` has run_ts, error, page and count of each run, in order. Committing them
    one after another would leave the same listing, changes and log."""
    for lo in range(0, len(announced), BACKLOG_RUNS):
        part = announced[lo : lo + BACKLOG_RUNS]
        runs = [(x["run_ts"], x["error"]) for x in part]
        times = [ts for ts, _ in runs]
        first, last, head = times[0], times[-1], store.head(profile.site)
        snapshots = store.snapshots_of(profile.site, times)
        rows = backlog_rows(store.layered(profile.site, head.newest), snapshots, runs, head.clean, profile)
        found = changes_of(store.write_delta(rows, profile.site, first, last))
        store.write_changes_of(found, profile.site, times)
        totals = store.spark.createDataFrame(
            [(profile.site, x["run_ts"], x["error"], x["page"], x["count"], 0, 0, 0) for x in part], RUN_LOG
        )
        clean = max([ts for ts, error in runs if error == 0], default=head.clean)
        store.write_log(run_summary(found, totals), profile.site, first, last, clean, batch)
        store.fold(profile.site)


@dataclass(frozen=True)
class _Opened:
    """A site's pages of one run, parsed and checked; nothing lasting is written yet."""

    profile: Profile
    run: Run
    pages: DataFrame
    page: int
    count: int
    done: bool


def _open(
    payload: DataFrame, store: Store, profile: Profile, run_ts: datetime, commit: bool
) -> _Opened:
    """Parse a site's landed pages of one run and refuse what could not be committed.

    Parsed pages are written once to the shared folder, as totals, items and quarantine
    all read them."""
    of_run = payload.filter((F.col("site") == profile.site) & (F.col("run_ts") == F.lit(run_ts)))
    pages = settle(parse_pages(_spread(of_run), profile), f"pages-{profile.site}")
    totals = page_totals(pages, profile).first()
    if totals is None:
        # not an empty result: without any page, absence would mean that all is sold
        raise ValueError(f"{profile.site}: no page has landed for run {run_ts}")
    run = store.open_run(profile.site, run_ts, totals["error"])
    done = commit and run.late and not _logged(store, profile.site, run_ts).isEmpty()
    if commit and run.late and not done:
        raise ValueError(f"{profile.site}: run {run_ts} is not newer than the last commit")
    return _Opened(profile, run, pages, totals["page"], totals["count"], done)


def _spread(payload: DataFrame) -> DataFrame:
    """Landed pages dealt to all cores. Bodies compress well, so that many pages may lie in
    one file, which one task would parse whole."""
    return payload.repartition("run_ts", "keyword", "page")


def _logged(store: Store, site: str, run_ts: datetime) -> DataFrame:
    return store.run_log().filter((F.col("site") == site) & (F.col("run_ts") == F.lit(run_ts)))


def _finish(opened: _Opened, store: Store, rules: DataFrame | None, commit: bool) -> RunResult:
    profile, run, pages = opened.profile, opened.run, opened.pages
    quarantine = quarantine_of(pages, profile)
    if opened.done:
        # committed before, perhaps by a call that failed at a later site
        changes = store.changes_of(run.site, run.run_ts)
        return RunResult(run, changes, _logged(store, run.site, run.run_ts), quarantine)
    snapshot = dedup_first(observations_of(pages, profile))
    removed = None
    if rules is not None:
        snapshot, removed = apply_rules(snapshot, rules, profile.site)
    snapshot = snapshot.select(*OBSERVATION.names)
    if commit:
        store.write_snapshot(snapshot, [(run.site, run.run_ts)])
        snapshot = store.snapshot(run.site, run.run_ts)
    result = run_snapshot(store, snapshot, profile, run, opened.page, opened.count, commit)
    return replace(result, quarantine=quarantine, removed=removed)


def run_site(
    payload: DataFrame,
    store: Store,
    profile: Profile,
    run_ts: datetime,
    rules: DataFrame | None = None,
    commit: bool = False,
) -> RunResult:
    """One site's landed pages of one run: parse -> de-duplicate -> rules -> diff.

    Preview (`commit=False`) leaves listing and log alone. Committing a run that is in the
    log already changes nothing and gives what it found then.
    """
    use_utc(store.spark)
    run_ts = as_utc(run_ts)
    return _finish(_open(payload, store, profile, run_ts, commit), store, rules, commit)


def run_history(
    payload: DataFrame,
    store: Store,
    profiles: Iterable[Profile] = tuple(PROFILES.values()),
    rules: DataFrame | None = None,
) -> None:
    """Commit all landed runs that are newer than each site's log, oldest first: a fixed
    number of jobs per site, however many runs there are. The driver sees a row per run."""
    use_utc(store.spark)
    for profile in profiles:
        own = payload.filter(F.col("site") == profile.site)
        newest = store.head(profile.site).newest
        if newest is not None:
            own = own.filter(F.col("run_ts") > F.lit(newest))
        pages = settle(parse_pages(_spread(own), profile), f"pages-{profile.site}")
        totals = page_totals(pages, profile).withColumn("us", micros(F.col("run_ts"))).orderBy("us")
        announced = [{**x.asDict(), "run_ts": from_micros(x["us"])} for x in totals.collect()]
        if not announced:
            continue
        snapshot = dedup_first(observations_of(pages, profile))
        if rules is not None:
            snapshot, _ = apply_rules(snapshot, rules, profile.site)
        store.write_snapshot(snapshot.select(*OBSERVATION.names))
        commit_runs(store, profile, announced)


def run_all(
    payload: DataFrame,
    store: Store,
    run_ts: datetime,
    profiles: Iterable[Profile] = tuple(PROFILES.values()),
    rules: DataFrame | None = None,
    commit: bool = False,
) -> tuple[DataFrame, Mapping[str, RunResult]]:
    """All sites of one run. Returns the digest parts, sites in order, and each result.

    All sites are parsed and checked before the first is committed. If a commit fails
    halfway nevertheless, the same call again finishes the sites that are missing.
    """
    use_utc(store.spark)
    profiles, run_ts = list(profiles), as_utc(run_ts)
    opened = [_open(payload, store, p, run_ts, commit) for p in profiles]
    results = {o.profile.site: _finish(o, store, rules, commit) for o in opened}
    lines = None
    for profile in profiles:
        result = results[profile.site]
        own = digest_lines(result.changes, result.summary, profiles)
        lines = own if lines is None else lines.unionByName(own)
    return cut_lines(lines), results
