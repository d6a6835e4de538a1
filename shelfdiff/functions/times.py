"""Column functions on time, and instants on the driver."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Tokyo"


def end_time(text: Column) -> Column:
    """Epoch seconds as text, fraction kept, to an instant; NULL if unreadable."""
    return F.timestamp_seconds(text.try_cast("double"))


def local_time(ts: Column, tz: str = LOCAL_ZONE) -> Column:
    """An instant as `yyyy-MM-dd HH:mm:ss+hh:mm` in a zone, fractions cut off.

    Needs a UTC session (`shelfdiff.session.use_utc`), as text forms do throughout.
    """
    local = F.from_utc_timestamp(ts, tz)
    minutes = ((F.unix_seconds(local) - F.unix_seconds(ts)) / 60).cast("int")
    offset = F.format_string(
        "%s%02d:%02d",
        F.when(minutes < 0, "-").otherwise("+"),
        F.floor(F.abs(minutes) / 60).cast("int"),
        F.abs(minutes) % 60,
    )
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), offset)


def ended(end_ts: Column, run_ts: Column) -> Column:
    """The listing's closing time has passed at the time of the run."""
    return end_ts <= run_ts


def as_utc(ts: datetime) -> datetime:
    """An instant with its zone. A naive time is local, as Spark takes it."""
    return ts.astimezone(timezone.utc)


def micros(ts: Column) -> Column:
    """How instants leave a query for the driver: no zone of any machine is involved."""
    return F.unix_micros(ts)


def from_micros(value: int | None) -> datetime | None:
    if value is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=value)
