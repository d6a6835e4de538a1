"""Rule profiles: what counts as a change on which kind of site.

A rule is SQL text over one row that holds the item as seen now and as known before:

    price, full_price, bid_num, onsale, run_ts      this sighting
    p_price, p_full_price, p_bid_num, p_onsale      the stored listing
    p_ts                                            last seen, NULL = never seen
    last_stable                                     newest earlier run without errors

The same text is used by the one-run diff (`detect`), the history replay (`replay`) and
the merge-time diff, so a new site is a new `Profile` value and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from shelfdiff.sources import html, parsers


@dataclass(frozen=True)
class Profile:
    site: str
    heading: str
    # kind -> rule, for items of the snapshot
    changes: Mapping[str, str]
    # columns that the merge overwrites for known items
    update_cols: tuple[str, ...]
    # kind reported for stored items missing from a clean snapshot, if absence counts
    gone_kind: str | None = None
    # kinds whose text columns come from the stored listing
    stored_text: frozenset[str] = frozenset()
    # digest sections in order: kind -> label
    sections: Mapping[str, str] = field(default_factory=dict)
    # True: keywords have several pages, the first page tells how many
    paged: bool = False
    # body -> array<map> of raw items (NULL = bad page), raw item -> observation columns
    parse: Callable[[Column], Column] | None = None
    fields: Callable[[Column], dict[str, Column]] | None = None
    required: tuple[str, ...] = ()

    @property
    def kinds(self) -> tuple[str, ...]:
        return (*self.changes, *((self.gone_kind,) if self.gone_kind else ()))

    @property
    def auction(self) -> bool:
        return "bid" in self.changes


# Site names and digest headings.
PRESENCE = Profile(
    site="lashinbang",
    heading="Lashinbang Updater",
    changes={
        "new": "p_ts is null or p_ts < last_stable",
        "discount": "p_price > price",
    },
    update_cols=("price",),
    gone_kind="sold",
    stored_text=frozenset({"discount", "sold"}),
    sections={"new": "NEW", "discount": "DISCOUNT", "sold": "SOLD"},
    paged=True,
    parse=parsers.callback_items,
    fields=parsers.callback_fields,
    required=parsers.CALLBACK_REQUIRED,
)

STATUS = Profile(
    site="mercari",
    heading="Mercari Updater",
    changes={
        "new": "onsale = 1 and (p_ts is null or p_onsale = 0)",
        "discount": "onsale = 1 and p_price > price",
        "sold": "onsale = 0 and (p_ts is null or p_onsale = 1)",
    },
    update_cols=("price", "onsale"),
    sections={"new": "NEW", "discount": "DISCOUNT", "sold": "SOLD"},
    parse=parsers.json_items,
    fields=parsers.json_fields,
    required=parsers.JSON_REQUIRED,
)

AUCTION = Profile(
    site="yahoo",
    heading="Yahoo Updater",
    changes={
        # a day is 86,400 seconds, whatever the session's time zone
        "new": "p_ts is null or unix_micros(last_stable) - unix_micros(p_ts) > 86400000000",
        "discount": "(p_price > price or p_full_price > full_price) and p_bid_num = 0",
        "bid": "p_bid_num < bid_num",
    },
    update_cols=("price", "full_price", "end_ts", "bid_num"),
    sections={"new": "NEW", "discount": "DISCOUNT", "bid": "BID"},
    parse=html.auction_column,
    fields=parsers.html_fields,
    required=parsers.HTML_REQUIRED,
)

PROFILES: dict[str, Profile] = {p.site: p for p in (PRESENCE, STATUS, AUCTION)}
