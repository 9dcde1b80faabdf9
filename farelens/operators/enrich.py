"""Add zone names and derived columns to clean trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions import derive
from farelens.session import broadcast_if_bounded


def join_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left-join the zone dimension twice, for pickup and for dropoff.

    The dimension is broadcast after its size was counted; a large one takes a shuffle join, in
    which AQE splits hot zones.
    """
    zones = broadcast_if_bounded(zones.select("location_id", "zone", "borough"))
    for role, key in (("pickup", "pu_location_id"), ("dropoff", "do_location_id")):
        side = zones.select(
            F.col("location_id").alias(f"_{role}_id"),
            F.col("zone").alias(f"{role}_zone"),
            F.col("borough").alias(f"{role}_borough"),
        )
        trips = trips.join(side, F.col(key) == F.col(f"_{role}_id"), "left").drop(f"_{role}_id")
    return trips


def add_time_columns(trips: DataFrame) -> DataFrame:
    """Derived columns under the batch rules."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return trips.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_hour": derive.pickup_hour(pickup),
            "pickup_day_name": derive.day_name(pickup),
            "is_weekend": derive.is_weekend(pickup),
            "trip_duration_minutes": derive.whole_minutes(pickup, dropoff),
            "time_period": derive.time_period(F.hour(pickup), null_is_night=True),
            "payment_label": derive.payment_label(F.col("payment_type")),
            "store_and_fwd_flag_label": derive.store_flag_label(F.col("store_and_fwd_flag")),
        }
    )


def enrich_trips(clean: DataFrame, zones: DataFrame) -> DataFrame:
    return add_time_columns(join_zones(clean, zones))
