"""A sequential model of the rules: one site, one run after another, plain dictionaries.

Written from the rules alone and sharing no code with the package.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta
from itertools import groupby


@dataclass
class Site:
    kind: str  # "presence", "status" or "auction"
    state: dict = field(default_factory=dict)
    clean: list = field(default_factory=list)

    def run(self, ts: datetime, items: dict, error: int) -> list[tuple]:
        """Changes (kind, item, old price, new price) of one run, then the merge."""
        last = max(self.clean) if self.clean else None
        found = self._diff(ts, items, error, last) if last is not None else []
        for item, now in items.items():
            old = self.state.get(item)
            if old is None:
                self.state[item] = dict(now, record=ts, update=ts)
            else:
                moving = {
                    "presence": ("price",),
                    "status": ("price", "onsale"),
                    "auction": ("price", "full", "num"),
                }[self.kind]
                old.update({c: now[c] for c in moving}, update=ts)
        if error == 0:
            self.clean.append(ts)
        return found

    def _diff(self, ts, items, error, last):
        out = []
        for item, now in items.items():
            old = self.state.get(item)
            price = now["price"]
            before = old["price"] if old else None

            def lower(a, b):
                return a is not None and b is not None and a > b

            if self.kind == "presence":
                if old is None or old["update"] < last:
                    out.append(("new", item, before, price))
                if old and lower(before, price):
                    out.append(("discount", item, before, price))
            elif self.kind == "status":
                if now["onsale"] == 1:
                    if old is None or old["onsale"] == 0:
                        out.append(("new", item, before, price))
                    if old and lower(before, price):
                        out.append(("discount", item, before, price))
                elif old is None or old["onsale"] == 1:
                    out.append(("sold", item, before, price))
            else:
                if old is None or old["update"] < last - timedelta(days=1):
                    out.append(("new", item, before, price))
                if old and old["num"] == 0 and (
                    lower(before, price) or lower(old["full"], now["full"])
                ):
                    out.append(("discount", item, before, price))
                if old and old["num"] is not None and now["num"] is not None and old["num"] < now["num"]:
                    out.append(("bid", item, before, price))
        if self.kind == "presence" and error == 0:
            for item, old in self.state.items():
                if item not in items and old["update"] >= last:
                    out.append(("sold", item, old["price"], None))
        return out


def play(kind: str, rows: list[dict], errors: dict[datetime, int]) -> tuple[list, dict]:
    """All changes (ts, kind, item, old, new) and the final state; rows hold ts and item."""
    site, out = Site(kind), []
    by_run = {
        ts: {r["item"]: r for r in group}
        for ts, group in groupby(sorted(rows, key=lambda r: r["ts"]), key=lambda r: r["ts"])
    }
    for ts in sorted(errors):
        items = {
            i: {c: r[c] for c in ("price", "full", "num", "onsale", "title")}
            for i, r in by_run.get(ts, {}).items()
        }
        out += [(ts, *c) for c in site.run(ts, items, errors[ts])]
    return out, site.state
