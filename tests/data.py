"""Small made-up histories in the package's schemas."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from shelfdiff import AUCTION, PRESENCE, STATUS
from shelfdiff.schema import OBSERVATION, RUN_LOG

KINDS = {"presence": PRESENCE, "status": STATUS, "auction": AUCTION}
START = datetime(2024, 1, 1)


def history(seed: int, n_runs: int = 14, n_items: int = 9, hours: int = 9):
    """Random rows and errors: vanishing items, equal prices, NULLs, faulty runs."""
    rnd = random.Random(seed)
    rows, errors = [], {}
    for n in range(n_runs):
        ts = START + timedelta(hours=hours * n, microseconds=n)
        errors[ts] = int(rnd.random() < 0.35)
        for item in range(n_items):
            if rnd.random() < 0.55:
                rows.append(
                    {
                        "ts": ts,
                        "item": f"i{item}",
                        "price": rnd.choice([None, 100, 200, 200, 300]),
                        "full": rnd.choice([None, 0, 500, 900]),
                        "num": rnd.choice([0, 0, 1, 2]),
                        "onsale": rnd.choice([0, 1]),
                        "title": rnd.choice([None, f"t{n}"]),
                    }
                )
    return rows, errors


def observations(spark, site: str, rows: list[dict]):
    full = [
        {
            "site": site,
            "run_ts": r["ts"],
            "keyword": "k",
            "page": 1,
            "pos": n,
            "item_id": r["item"],
            "title": r.get("title"),
            "price": r.get("price"),
            "full_price": r.get("full"),
            "bid_num": r.get("num"),
            "onsale": r.get("onsale"),
        }
        for n, r in enumerate(rows)
    ]
    return spark.createDataFrame(
        [tuple(f.get(c) for c in OBSERVATION.names) for f in full], OBSERVATION
    )


def run_log(spark, site: str, errors: dict):
    return spark.createDataFrame(
        [(site, ts, e, 1, 0, 0, 0, 0) for ts, e in sorted(errors.items())], RUN_LOG
    )


def change_rows(df) -> list[tuple]:
    return sorted(
        (
            (r["run_ts"], r["kind"], r["item_id"], r["old_price"], r["new_price"])
            for r in df.collect()
        ),
        key=repr,
    )
