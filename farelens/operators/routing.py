"""Split flagged trips into clean and quarantined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.operators.numbering import number_by_ranges
from farelens.operators.rules import RULE_NAMES
from farelens.session import materialize

FLAG_COLUMNS = (
    "is_valid",
    "quarantine_reason",
    "amount_mismatch",
    *RULE_NAMES,
    "is_duplicate",
    "total_amount_recomputed",
)


def clean_trips(flagged: DataFrame) -> DataFrame:
    """Valid rows without the flag columns."""
    return flagged.filter("is_valid = true").drop(*FLAG_COLUMNS, "n_copies")


def unrouted_trips(flagged: DataFrame) -> DataFrame:
    """Rows whose validity is NULL: neither clean nor quarantined under the ``sql`` policy."""
    return flagged.filter("is_valid is null")


def quarantine_trips(flagged: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """Invalid rows, numbered within equal trip keys (``dup_seq``) so that each row has a key.

    The order is fare, then distance, then every other column, so the numbers do not change between runs. A key
    of one row gets 1; the keys of several are found by their counts and numbered over ranges, whatever their size.
    ``flagged`` is read three times, so it should be stored, not a plan that joins and flags the trips.
    """
    columns = [c for c in flagged.columns if c != "n_copies"]
    invalid = flagged.filter("is_valid = false").select(*columns)
    order = ["fare_amount", "trip_distance"]
    order += [c for c in columns if c not in (*order, "trip_id", "_loaded_at")]
    again = invalid.groupBy("trip_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(F.col("trip_id").alias("_id"))
    again = materialize(again, "quarantine-keys")
    same = F.col("trip_id").eqNullSafe(F.col("_id"))
    single = invalid.join(again, same, "left_anti").withColumn("dup_seq", F.lit(1).cast("bigint"))
    several = number_by_ranges(invalid.join(again, same, "left_semi"), ["trip_id"], order, "dup_seq")
    numbered = single.unionByName(several)
    return numbered.withColumn("dq_checked_at", F.current_timestamp() if checked_at is None else checked_at)
