"""Wall-clock helpers. All of them keep timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def truncated(ts: Column, grain: str) -> Column:
    return F.date_trunc(grain, ts).cast("timestamp_ntz")


def hour_key(ts: Column, zone: str | None = None) -> Column:
    """yyyyMMddHH of a UTC time, seen from ``zone`` when one is given."""
    local = F.from_utc_timestamp(ts, zone) if zone else ts
    return F.date_format(local, "yyyyMMddHH")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes from start to end."""
    return (micros(end) - micros(start)) / F.lit(float(MICROS_PER_MINUTE))


def plus_minutes(ts: Column, minutes: Column) -> Column:
    """Add a number of minutes, fractions included, held in a column."""
    step = F.rint(minutes.cast("double") * MICROS_PER_MINUTE).cast("long")
    return F.timestamp_add("MICROSECOND", step, ts)


def parsed(text: Column) -> Column:
    """Read ``yyyy-MM-dd HH:mm:ss``; other text gives NULL."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def iso(ts: Column) -> Column:
    """ISO 8601 text; microseconds are shown only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(micros(ts) % F.lit(1_000_000) == 0, whole).otherwise(full)
