"""Standardize raw trips and zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions import derive

# Raw column -> staged column.
TRIP_COLUMNS = {
    "VendorID": "vendor_id",
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
    "trip_type": "trip_type",
    "congestion_surcharge": "congestion_surcharge",
    "cbd_congestion_fee": "cbd_congestion_fee",
}
ZONE_COLUMNS = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}


def stage_trips(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rename to snake case, drop ``ehail_fee``, add period and audit columns.

    A raw table that is already stored by ``source_period`` keeps that column, so a filter on it
    prunes folders; otherwise the period is computed from the pickup time.
    """
    pickup = F.col("lpep_pickup_datetime")
    period = F.col("source_period") if "source_period" in raw.columns else derive.month_key(pickup)
    return raw.select(
        period.alias("source_period"),
        *[F.col(old).alias(new) for old, new in TRIP_COLUMNS.items()],
        (F.current_timestamp() if as_of is None else as_of).alias("_loaded_at"),
        F.lit("batch").alias("_data_source"),
    )


def stage_zones(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(old).alias(new) for old, new in ZONE_COLUMNS.items()])


def for_period(staged: DataFrame, period: str) -> DataFrame:
    """Rows of one reporting period, ``YYYY-MM``.

    Also states the period as a range of pickup times: the optimizer cannot see through a computed
    month text, but it can skip Parquet row groups by a range.
    """
    start = F.to_timestamp(F.lit(f"{period}-01"))
    pickup = F.col("pickup_datetime")
    return staged.filter(
        (F.col("source_period") == period)
        & (pickup >= start)
        & (pickup < F.add_months(start, 1).cast("timestamp"))
    )
