"""The digest: one line per change, cut into message parts of limited size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.functions.text import PART_LIMIT
from shelfdiff.functions.times import local_time
from shelfdiff.profiles import PROFILES, Profile
from shelfdiff.schema import PARTS
from shelfdiff.session import shared_folder

LINE_KEYS = ("site_no", "site", "run_ts", "section", "entry", "item_id")

# Message texts, with {} for each value.
HEADER = "<b>{}</b><br>Time: {}<br>Entries: {}    Error: {}<br>"
SECTION = "<br><b>[{}] ---------- {}</b><br>"
ITEM = '<a href="{}">{}  {}</a><br>'
PRICE = "JPY {}<br>"
PRICE_DROP = "JPY {} -> {}<br>"
AUCTION_STATE = "JPY {}    {} bid<br>End {}<br>"
BUY_NOW = "{}[{}]"
FROM_TO = "{} -> {}"
ABSENT = "None"


def _fill(template: str, *values: Column | str) -> Column:
    """A text with values in place of its braces; an absent value reads None."""
    pieces = template.split("{}")
    out = [F.lit(pieces[0])]
    for value, text in zip(values, pieces[1:], strict=True):
        column = F.col(value) if isinstance(value, str) else value
        out += [F.coalesce(column.cast("string"), F.lit(ABSENT)), F.lit(text)]
    return F.concat(*out)


def header_line(profile: Profile) -> Column:
    return _fill(HEADER, F.lit(profile.heading), local_time(F.col("run_ts")), "count", "error")


def _price_line(kind: str, gone: bool) -> Column:
    if kind == "discount":
        return _fill(PRICE_DROP, "old_price", "new_price")
    return _fill(PRICE, "old_price" if gone else "new_price")


def _auction_line(kind: str) -> Column:
    """Bid price, the buy-now price beside it where the new one is set, bids, closing time."""

    def money(bid: str, full: str) -> Column:
        buy_now = F.when(F.col("new_full") > 0, _fill(BUY_NOW, bid, full))
        return F.coalesce(buy_now, _fill("{}", bid))

    price, bids = money("new_price", "new_full"), _fill("{}", "new_num")
    if kind == "discount":
        price = _fill(FROM_TO, money("old_price", "old_full"), price)
    if kind == "bid":
        bids = _fill(FROM_TO, "old_num", bids)
    return _fill(AUCTION_STATE, price, bids, local_time(F.col("end_ts")))


def change_line(profile: Profile, kind: str) -> Column:
    """Two rows of message text. Line breaks inside its texts become spaces, so that a
    change stays one line of the message."""
    texts = [F.translate(c, "\r\n", "  ") for c in ("item_url", "item_id", "title")]
    link = _fill(ITEM, *texts)
    own = _auction_line(kind) if profile.auction else _price_line(kind, kind == profile.gone_kind)
    return F.concat(link, own)


def _section_totals(
    changes: DataFrame, summary: DataFrame, profiles: list[Profile]
) -> tuple[DataFrame, dict[str, str]]:
    """The summary column that counts each kind. Kinds that the log has no count of its own
    for are counted here."""
    totals = {"new": "new", "discount": "discount", "sold": "sold", "bid": "sold"}
    others = sorted({k for p in profiles for k in p.sections if k not in totals})
    if others:
        kind = F.col("kind")
        counts = changes.groupBy("site", "run_ts").agg(
            *[F.count_if(kind == k).alias(f"_n_{k}") for k in others]
        )
        summary = summary.join(counts, ["site", "run_ts"], "left")
        summary = summary.fillna(0, [f"_n_{k}" for k in others])
        totals |= {k: f"_n_{k}" for k in others}
    return summary, totals


def digest_lines(changes: DataFrame, summary: DataFrame, profiles: Iterable[Profile]) -> DataFrame:
    """All lines of all runs with their sort keys: header, then section by section.

    Sites come in the order of `profiles`, items of a section in the order of their id.
    """
    profiles = list(profiles)
    summary, totals = _section_totals(changes, summary, profiles)
    pick_site = F.lit(None).cast("int")
    heads, lines, sections = [], F.lit(None).cast("string"), F.lit(None).cast("int")
    for no, profile in enumerate(profiles):
        here = F.col("site") == profile.site
        pick_site = F.when(here, no).otherwise(pick_site)
        entries = [F.struct(F.lit(0).alias("section"), header_line(profile).alias("line"))]
        for order, (kind, label) in enumerate(profile.sections.items(), start=1):
            entries.append(
                F.struct(
                    F.lit(order).alias("section"),
                    _fill(SECTION, F.lit(label), totals[kind]).alias("line"),
                )
            )
            match = here & (F.col("kind") == kind)
            lines = F.when(match, change_line(profile, kind)).otherwise(lines)
            sections = F.when(match, order).otherwise(sections)
        heads.append(F.when(here, F.array(*entries)))

    headers = summary.select(
        pick_site.alias("site_no"), "site", "run_ts", F.inline(F.coalesce(*heads))
    ).select("site_no", "site", "run_ts", "section", F.lit(0).alias("entry"), F.lit("").alias("item_id"), "line")
    items = changes.select(
        pick_site.alias("site_no"),
        "site",
        "run_ts",
        sections.alias("section"),
        F.lit(1).alias("entry"),
        "item_id",
        lines.alias("line"),
    ).filter(F.col("line").isNotNull())
    return headers.unionByName(items)


def cut_lines(lines: DataFrame, limit: int = PART_LIMIT) -> DataFrame:
    """Each run's lines joined in order and cut into parts of `limit` characters.

    Lines hold no newline, so a message is cut by length alone and part k is characters
    [k * limit, (k + 1) * limit). That lets every line find its place from the lengths
    before it: no task ever holds a run's whole message, only a part of `limit`
    characters. The lengths before a line are summed in two steps, inside range
    partitions and over their totals, so a run with a third of all lines is spread too.
    """
    spark = lines.sparkSession
    shared_folder(spark)
    run = ["site_no", "site", "run_ts"]
    # The slot must mean the same rows in both uses below: fix it on shared storage.
    ranged = (
        lines.filter(F.length("line") > 0)
        .repartitionByRange(*LINE_KEYS)
        .withColumn("slot", F.spark_partition_id())
        .checkpoint()
    )
    in_slot = Window.partitionBy(*run, "slot").orderBy("section", "entry", "item_id")
    size = F.length("line")
    placed = ranged.withColumn(
        "start", F.sum(size).over(in_slot.rowsBetween(Window.unboundedPreceding, -1))
    )
    before = Window.partitionBy(*run).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranged.groupBy(*run, "slot")
        .agg(F.sum(size).alias("total"))
        .select(*run, "slot", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )
    start = F.coalesce(F.col("start"), F.lit(0)) + F.col("base")
    spread = placed.join(bases, [*run, "slot"]).withColumn("start", start)
    first, last = F.floor(F.col("start") / limit), F.floor((F.col("start") + size - 1) / limit)
    pieces = spread.withColumn("part_no", F.explode(F.sequence(first, last)))
    offset = F.greatest(F.col("part_no") * limit - F.col("start"), F.lit(0))
    end = F.least((F.col("part_no") + 1) * limit - F.col("start"), size)
    piece = F.substring("line", (offset + 1).cast("int"), (end - offset).cast("int"))
    body = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("start", piece.alias("text")))), lambda p: p["text"]
        ),
        "",
    )
    parts = pieces.groupBy(*run, "part_no").agg(body.alias("body"))
    return parts.select(*[F.col(f.name).cast(f.dataType) for f in PARTS], "site_no")


def digest(
    changes: DataFrame,
    summary: DataFrame,
    profiles: Iterable[Profile] | None = None,
    limit: int = PART_LIMIT,
) -> DataFrame:
    """Message parts of all runs in `summary`, sites in the order of `profiles`."""
    chosen = list(PROFILES.values() if profiles is None else profiles)
    return cut_lines(digest_lines(changes, summary, chosen), limit)
