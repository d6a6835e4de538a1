"""Table schemas shared by every module."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
}


def table_schema(columns: str) -> T.StructType:
    """Columns as text; needs no session, so that modules can be imported before one."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PAYLOAD = table_schema(
    "site string, run_ts timestamp, keyword string, page int, status int, body string"
)

# What one item record of one run looks like, whatever site it came from.
OBSERVATION = table_schema(
    "site string, run_ts timestamp, keyword string, page int, pos int, item_id string,"
    " seller_id string, title string, item_url string, image_url string, price bigint,"
    " full_price bigint, bid_num int, onsale int, end_ts timestamp"
)

# One row per (site, item_id). record_ts = first seen, update_ts = last seen.
LISTING = table_schema(
    "site string, item_id string, seller_id string, title string, item_url string,"
    " image_url string, price bigint, full_price bigint, bid_num int, onsale int,"
    " end_ts timestamp, record_ts timestamp, update_ts timestamp"
)

# `sold` also carries the bid count of auction sites.
RUN_LOG = table_schema(
    "site string, run_ts timestamp, error bigint, page bigint, count bigint,"
    " new bigint, discount bigint, sold bigint"
)

CHANGES = table_schema(
    "site string, run_ts timestamp, kind string, item_id string, title string,"
    " item_url string, image_url string, old_price bigint, new_price bigint,"
    " old_full bigint, new_full bigint, old_num int, new_num int, end_ts timestamp"
)

RULES = table_schema("rule_id bigint, site string, predicate string")

PARTS = table_schema("site string, run_ts timestamp, part_no bigint, body string")

# Text columns are kept as first seen, measures follow the newest sighting.
TEXT_COLUMNS = ("title", "item_url", "image_url")
MEASURES = ("price", "full_price", "bid_num", "onsale")
