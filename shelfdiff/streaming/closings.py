"""The end of an auction as an event: raised once the watermark has passed the closing time
that an item was last seen with, and no newer sighting came before it.

That is an outer join of the sightings with themselves: a sighting waits in the state for a
newer one of its item up to its closing time. When the watermark passes that time none can
come any more, and the sighting leaves the state without a match: the event. Sightings may
come late and in any order, as long as they are within the watermark's delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM = ("site", "item_id")
SHOWN = ("title", "item_url", "image_url", "price", "full_price", "bid_num", "end_ts")


def stream_closings(sightings: DataFrame, late: str = "1 day", longest: str = "60 days") -> DataFrame:
    """Streaming rows of items whose newest sighting has run out: the sighting's columns,
    `run_ts` when it was last seen, and `ended`.

    `late` is how far a sighting may lag behind the newest run, and so how long an event
    waits. `longest` bounds the state: a sighting that closes later than that after its run
    is given out at that time, if nothing newer came, with `ended` false. A sighting with
    no closing time never ends; one that had closed when it was seen ends at its run.
    """
    horizon = F.expr(f"interval {longest}")
    closes = F.greatest("end_ts", "run_ts")
    seen = (
        sightings.filter("end_ts is not null")
        .select(*ITEM, "run_ts", *SHOWN, F.least(closes, F.col("run_ts") + horizon).alias("due"))
        .withWatermark("due", late)
    )
    newer = sightings.select(
        F.col("site").alias("_site"), F.col("item_id").alias("_item"), F.col("run_ts").alias("_ts")
    ).withWatermark("_ts", late)
    # The last condition follows from the others; it tells Spark when a newer sighting can
    # leave the state.
    follows = (
        (F.col("site") == F.col("_site"))
        & (F.col("item_id") == F.col("_item"))
        & (F.col("_ts") > F.col("run_ts"))
        & (F.col("_ts") <= F.col("due"))
        & (F.col("_ts") > F.col("due") - horizon)
    )
    alone = seen.join(newer, follows, "left_outer").filter("_ts is null")
    return alone.select(*ITEM, "run_ts", *SHOWN, (F.col("end_ts") <= F.col("due")).alias("ended"))
