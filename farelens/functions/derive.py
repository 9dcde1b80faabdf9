"""Derived trip columns. Every function takes and returns Columns and stays inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, and the first hour of each part of the day.
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
STORE_FLAG_LABELS = {"Y": "Store and Forward", "N": "Normal"}
DAY_PARTS = {0: "Late Night", 6: "Morning", 12: "Afternoon", 17: "Evening", 21: "Night"}
UNKNOWN_LABEL = "Unknown"

KEY_SEPARATOR = "\x1f"


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def pickup_hour(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes."""
    return (micros(end) - micros(start)) / F.lit(60_000_000.0)


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes, cut toward zero (batch rule)."""
    return F.timestamp_diff("MINUTE", start, end)


def rounded_minutes(start: Column, end: Column) -> Column:
    """Minutes rounded half to even (stream rule)."""
    return F.bround(elapsed_minutes(start, end), 0).cast("bigint")


def time_period(hour: Column, null_is_night: bool) -> Column:
    """Part of the day. A NULL hour is ``Night`` in batch and NULL in the stream."""
    *earlier, (_, last) = sorted(DAY_PARTS.items())
    starts = [*sorted(DAY_PARTS)[1:]]
    label = None
    for (_, name), upper in zip(earlier, starts):
        label = (F if label is None else label).when(hour < upper, name)
    if null_is_night:
        return label.otherwise(last)
    return label.when(hour.isNotNull(), last)


def label_from(code: Column, labels: Mapping, default: str = UNKNOWN_LABEL) -> Column:
    """Text for a code; NULL and unlisted codes get ``default``."""
    result = None
    for value, name in labels.items():
        result = (F if result is None else result).when(code == F.lit(value), name)
    return result.otherwise(default)


def payment_label(code: Column) -> Column:
    return label_from(code, PAYMENT_LABELS)


def store_flag_label(flag: Column) -> Column:
    return label_from(flag, STORE_FLAG_LABELS)


def parse_iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; empty, NULL and unreadable text give NULL."""
    return F.try_to_timestamp(text)


def surrogate_key(cols: Sequence[Column], sep: str = KEY_SEPARATOR, digest: str = "md5") -> Column:
    """Key made of the text of ``cols`` with NULL as empty text.

    ``md5`` keeps 128 bits: at hundreds of billions of trips a 64-bit key is expected to collide.
    ``xxhash64`` gives the compact 64-bit form. An empty ``sep`` lets (1, 12) and (11, 2) collide.
    """
    text = F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.md5(text) if digest == "md5" else F.xxhash64(text)


def trip_key(sep: str = KEY_SEPARATOR, digest: str = "md5") -> Column:
    """Key of a trip: vendor, both times (microseconds since the epoch) and both locations."""
    return surrogate_key(
        [
            F.col("vendor_id"),
            micros(F.col("pickup_datetime")),
            micros(F.col("dropoff_datetime")),
            F.col("pu_location_id"),
            F.col("do_location_id"),
        ],
        sep,
        digest,
    )


def safe_divide(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)
