"""Listing change detection on Spark."""

from shelfdiff.functions.text import split_text
from shelfdiff.functions.times import local_time
from shelfdiff.operators.dedup import dedup_first
from shelfdiff.operators.detect import detect, open_run
from shelfdiff.operators.digest import digest, digest_lines
from shelfdiff.operators.merge import listing_state, merge
from shelfdiff.operators.replay import replay
from shelfdiff.operators.rules import add_rule, apply_rules, get_rules, remove_rule
from shelfdiff.operators.runlog import last_stable, run_summary, with_stable
from shelfdiff.plans.run import RunResult, commit_runs, run_all, run_history, run_site
from shelfdiff.profiles import AUCTION, PRESENCE, PROFILES, STATUS, Profile
from shelfdiff.sources.payloads import page_totals, project
from shelfdiff.sources.tables import Store, find_id, table_ready

__all__ = [
    "AUCTION",
    "PRESENCE",
    "PROFILES",
    "STATUS",
    "Profile",
    "RunResult",
    "Store",
    "add_rule",
    "apply_rules",
    "commit_runs",
    "dedup_first",
    "detect",
    "digest",
    "digest_lines",
    "find_id",
    "get_rules",
    "last_stable",
    "local_time",
    "listing_state",
    "merge",
    "open_run",
    "page_totals",
    "project",
    "remove_rule",
    "replay",
    "run_all",
    "run_history",
    "run_site",
    "run_summary",
    "split_text",
    "table_ready",
    "with_stable",
]
