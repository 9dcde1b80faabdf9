"""Exploratory quality audit of raw trips."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions import derive
from farelens.operators.rules import UNKNOWN_ZONES
from farelens.session import broadcast_if_bounded

# Columns of the audit.
MONEY_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "cbd_congestion_fee",
)
FILLED_COMPONENTS = ("congestion_surcharge", "cbd_congestion_fee")
PLAIN_COMPONENTS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge")
CASH = 2


def _minutes() -> Column:
    return derive.elapsed_minutes(F.col("lpep_pickup_datetime"), F.col("lpep_dropoff_datetime"))


def _tall(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    wide = df.agg(*[F.count_if(cond).alias(name) for name, cond in counters.items()])
    return wide.unpivot([], list(counters), "check", "n_rows")


def out_of_period_rows(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Trips picked up before ``start`` or after ``end`` (both inclusive bounds)."""
    pickup = F.col("lpep_pickup_datetime")
    return df.filter((pickup < start) | (pickup > end))


def out_of_period(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Number of such trips per pickup month."""
    outside = out_of_period_rows(df, start, end)
    return outside.groupBy(derive.month_key(F.col("lpep_pickup_datetime")).alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def anomaly_counts(df: DataFrame) -> DataFrame:
    """Rows per anomaly, all counted in one pass."""
    minutes, distance, total = _minutes(), F.col("trip_distance"), F.col("total_amount")
    passengers = F.col("passenger_count")
    still = distance == 0
    counters = {
        "zero_duration": minutes == 0,
        "negative_duration": minutes < 0,
        "negative_distance": distance < 0,
        "zero_distance": still,
        "zero_distance_zero_duration": still & (minutes == 0),
        "zero_distance_positive_duration": still & (minutes > 0),
        "zero_distance_zero_total": still & (total == 0),
        "zero_distance_positive_total": still & (total > 0),
        "zero_distance_negative_total": still & (total < 0),
        "suspicious_zero_distance": still & (minutes == 0) & (total > 0),
        "negative_passengers": passengers < 0,
        "zero_passengers": passengers == 0,
        **{f"negative_{c}": F.col(c) < 0 for c in MONEY_COLUMNS},
        "cash_with_tip": (F.col("payment_type") == CASH) & (F.col("tip_amount") > 0),
    }
    return _tall(df, counters)


def suspicious_trips(df: DataFrame) -> DataFrame:
    """Trips that moved nowhere in no time but were charged."""
    return (
        df.withColumn("trip_duration_minutes", _minutes())
        .filter("trip_distance = 0 and trip_duration_minutes = 0 and total_amount > 0")
        .select("trip_distance", "trip_duration_minutes", "fare_amount", "tip_amount", "total_amount", "payment_type")
    )


def mismatch_count(df: DataFrame) -> DataFrame:
    """Trips whose components do not add up to the total.

    Only the two late surcharges count as zero when missing; any other missing part counts as a mismatch.
    """
    calculated = F.lit(0.0)
    for c in PLAIN_COMPONENTS:
        calculated = calculated + F.col(c)
    for c in FILLED_COMPONENTS:
        calculated = calculated + F.coalesce(F.col(c), F.lit(0.0))
    differs = F.round((calculated - F.col("total_amount")) * 100) != 0
    return _tall(df, {"total_amount_mismatch": F.coalesce(differs, F.lit(True))})


def location_audit(df: DataFrame, unknown_zones: Iterable[int] = UNKNOWN_ZONES) -> DataFrame:
    """Valid and failed locations, and which side is an unknown zone."""
    zones = list(unknown_zones)
    pu, do = F.col("PULocationID"), F.col("DOLocationID")
    bad_pu = F.coalesce(pu.isin(zones), F.lit(False))
    bad_do = F.coalesce(do.isin(zones), F.lit(False))
    valid = ~bad_pu & ~bad_do & pu.isNotNull() & do.isNotNull()
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("failed_rows"),
        F.count_if(bad_pu | bad_do).alias("unknown_zone_rows"),
        F.count_if(bad_pu & ~bad_do).alias("pickup_only"),
        F.count_if(~bad_pu & bad_do).alias("dropoff_only"),
        F.count_if(bad_pu & bad_do).alias("both_sides"),
    )
    return counts.withColumn("failed_pct", F.round(F.try_divide("failed_rows", "total_rows") * 100, 2))


def location_bounds(df: DataFrame, columns: Sequence[str] = ("PULocationID", "DOLocationID")) -> DataFrame:
    wide = df.agg(*[fn(c).alias(f"{n}_{c}") for c in columns for n, fn in (("min", F.min), ("max", F.max))])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"min_{c}").alias("minimum"), F.col(f"max_{c}").alias("maximum"))
                    for c in columns
                ]
            )
        )
    )


def audit_unmatched(df: DataFrame, zones: DataFrame, column: str = "PULocationID") -> DataFrame:
    """Trips per location id that finds no borough in the zone lookup.

    Trips are counted per id first, so the join sees one row per id.
    """
    counts = df.groupBy(F.col(column).alias("location_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    lookup = broadcast_if_bounded(zones.select(F.col("LocationID").alias("_id"), "Borough"))
    return counts.join(lookup, F.col("location_id") == F.col("_id"), "left").filter("Borough is null").select(
        "location_id", "n_rows"
    )
