"""The six marts.

Five marts sum and average the same measures over different keys. Trips are first reduced to
partial sums and counts (:func:`rollup_trips`); a mart adds partials up and divides at the end. A
mart given trips reduces them at its own keys. To build several marts, reduce the trips once at
``MART_GRAIN``, store that, and give it to each mart: the trips are then read once for all of them.
Partials of one period can be kept at each mart's keys (``PARTIALS``): a new or changed
period then replaces its own partials, and a mart adds up those of all periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measured columns and mart keys.
MEASURES = (
    "passenger_count",
    "total_amount",
    "fare_amount",
    "tip_amount",
    "trip_distance",
    "trip_duration_minutes",
)
DAILY_KEYS = ("pickup_date", "_data_source")
HOURLY_KEYS = ("pickup_date", "_data_source", "pickup_hour", "time_period", "is_weekend")
PAYMENT_KEYS = ("payment_type", "payment_label", "_data_source")
ROUTE_KEYS = ("pu_location_id", "do_location_id", "_data_source")
ZONE_NAMES = ("pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough")
MART_GRAIN = tuple(dict.fromkeys((*HOURLY_KEYS, *PAYMENT_KEYS, *ROUTE_KEYS, *ZONE_NAMES)))
# Tables of partials, and the marts that are built from each.
PARTIALS = {"daily": DAILY_KEYS, "hourly": HOURLY_KEYS, "payment": PAYMENT_KEYS, "route": (*ROUTE_KEYS, *ZONE_NAMES)}

_ROWS = "rows_n"


def partial_names() -> list[str]:
    return [_ROWS, *[f"sum_{m}" for m in MEASURES], *[f"n_{m}" for m in MEASURES]]


def rollup_trips(trips: DataFrame, keys: Sequence[str] = MART_GRAIN) -> DataFrame:
    """Row count, and sum and non-NULL count of each measure, per key."""
    return trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_ROWS),
        *[F.sum(m).alias(f"sum_{m}") for m in MEASURES],
        *[F.count(m).alias(f"n_{m}") for m in MEASURES],
    )


def _by(df: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Partials at ``keys``, from trips or from a finer rollup.

    ``extra`` columns depend on the keys. They are grouping columns of the first step, where rows
    are many, and are picked from the few partial rows: picking text during the first step would
    make Spark sort all trips.
    """
    if _ROWS not in df.columns:
        df = rollup_trips(df, [*keys, *extra])
        if not extra:
            return df
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in partial_names()],
        *[F.any_value(c, True).alias(c) for c in extra],
    )


def _sum(measure: str, name: str) -> Column:
    return F.col(f"sum_{measure}").alias(name)


def _avg(measure: str, name: str | None = None) -> Column:
    return F.try_divide(F.col(f"sum_{measure}"), F.col(f"n_{measure}")).alias(name or f"avg_{measure}")


def _trips() -> Column:
    return F.col(_ROWS).alias("total_trips")


def _refreshed(as_of: Column | None) -> Column:
    return (F.current_timestamp() if as_of is None else as_of).alias("marts_last_refreshed_at")


def daily_trips_summary(trips: DataFrame, as_of: Column | None = None) -> DataFrame:
    return (
        _by(trips, DAILY_KEYS)
        .select(
            "pickup_date",
            F.col("_data_source").alias("data_source"),
            _trips(),
            _sum("passenger_count", "total_passengers"),
            _avg("passenger_count"),
            _sum("total_amount", "total_revenue"),
            _avg("fare_amount"),
            _avg("tip_amount"),
            _sum("tip_amount", "total_tip_amount"),
            _avg("trip_distance"),
            _avg("trip_duration_minutes"),
            _refreshed(as_of),
        )
        .orderBy("pickup_date")
    )


def hourly_demand_summary(trips: DataFrame, as_of: Column | None = None) -> DataFrame:
    return (
        _by(trips, HOURLY_KEYS)
        .select(
            "pickup_date",
            F.col("_data_source").alias("data_source"),
            "pickup_hour",
            "time_period",
            "is_weekend",
            _trips(),
            _sum("total_amount", "total_revenue"),
            _avg("fare_amount"),
            _avg("tip_amount"),
            _avg("trip_distance"),
            _avg("trip_duration_minutes"),
            _sum("passenger_count", "total_passengers"),
            _avg("passenger_count"),
            _refreshed(as_of),
        )
        .orderBy("pickup_date", "pickup_hour")
    )


def payment_behavior_summary(trips: DataFrame, as_of: Column | None = None) -> DataFrame:
    return (
        _by(trips, PAYMENT_KEYS)
        .select(
            "payment_type",
            "payment_label",
            F.col("_data_source").alias("data_source"),
            _trips(),
            _sum("total_amount", "total_revenue"),
            _sum("tip_amount", "total_tip_amount"),
            _avg("fare_amount"),
            _avg("tip_amount"),
            _avg("trip_distance"),
            _avg("trip_duration_minutes"),
            _avg("passenger_count"),
            F.try_divide("sum_tip_amount", "sum_fare_amount").alias("tip_rate"),
            _refreshed(as_of),
        )
        .orderBy(F.desc("total_trips"), "payment_type")
    )


def route_performance_summary(trips: DataFrame, as_of: Column | None = None) -> DataFrame:
    return (
        _by(trips, ROUTE_KEYS, ("pickup_zone", "dropoff_zone"))
        .select(
            F.col("pu_location_id").alias("pickup_location_id"),
            F.col("do_location_id").alias("dropoff_location_id"),
            "pickup_zone",
            "dropoff_zone",
            F.col("_data_source").alias("data_source"),
            _trips(),
            _sum("total_amount", "total_revenue"),
            _sum("passenger_count", "total_passengers"),
            _avg("fare_amount"),
            _avg("tip_amount"),
            _avg("trip_distance"),
            _avg("trip_duration_minutes"),
            _avg("passenger_count"),
            _refreshed(as_of),
        )
        .orderBy(F.desc("total_trips"), "pickup_location_id", "dropoff_location_id")
    )


def zone_performance_summary(trips: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Pickups and dropoffs per location.

    Each route row is counted once for its pickup and once for its dropoff location, then all rows
    of a location are added up: every location that occurs on either side gets a row, without a join.
    A missing location keeps its row but, as with a join on it, matches no trips.
    """
    routes = _by(trips, ("pu_location_id", "do_location_id"), ZONE_NAMES)
    measures = ("total_amount", "fare_amount", "tip_amount", "trip_distance", "trip_duration_minutes", "passenger_count")

    def side(role: str) -> Column:
        location = F.col("pu_location_id" if role == "pickup" else "do_location_id")
        known = location.isNotNull()

        def kept(c: str, on: str) -> Column:
            return F.when(known & F.lit(role == on), F.col(c)).alias(f"{on}_{c}")

        return F.struct(
            location.alias("location_id"),
            kept(_ROWS, "pickup"),
            kept(_ROWS, "dropoff"),
            *[kept(f"{kind}_{m}", "pickup") for m in measures for kind in ("sum", "n")],
            *[
                F.when(known & F.lit(role == on), F.col(f"{on}_{what}")).alias(f"{on}_{what}")
                for on in ("pickup", "dropoff")
                for what in ("zone", "borough")
            ],
        )

    both = routes.select(F.inline(F.array(side("pickup"), side("dropoff"))))
    total = both.groupBy("location_id").agg(
        *[F.sum(c).alias(c) for c in both.columns if c.endswith(_ROWS) or "_sum_" in c or "_n_" in c],
        *[F.any_value(f"{on}_{w}", True).alias(f"{on}_{w}") for on in ("pickup", "dropoff") for w in ("zone", "borough")],
    )

    def avg(m: str) -> Column:
        return F.try_divide(f"pickup_sum_{m}", f"pickup_n_{m}").alias(f"avg_{m}")

    return total.select(
        "location_id",
        F.coalesce("pickup_zone", "dropoff_zone").alias("zone"),
        F.coalesce("pickup_borough", "dropoff_borough").alias("borough"),
        F.coalesce(f"pickup_{_ROWS}", F.lit(0)).alias("total_pickup_trips"),
        F.coalesce(f"dropoff_{_ROWS}", F.lit(0)).alias("total_dropoff_trips"),
        F.coalesce("pickup_sum_total_amount", F.lit(0.0)).alias("total_revenue"),
        *[avg(m) for m in measures[1:]],
        _refreshed(as_of),
    ).orderBy(F.desc("total_pickup_trips"), "location_id")


def batch_streaming_comparison(batch: DataFrame, stream: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Trip counts and averages of the batch and the stream side; an empty side gives no row."""

    def averages(df: DataFrame, source: Column) -> DataFrame:
        return df.groupBy(source.alias("data_source")).agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.round(F.avg("trip_distance"), 2).alias("avg_trip_distance"),
            F.round(F.avg("fare_amount"), 2).alias("avg_fare_amount"),
            F.round(F.avg("total_amount"), 2).alias("avg_total_amount"),
        )

    both = averages(batch, F.coalesce("_data_source", F.lit("batch"))).unionByName(
        averages(stream, F.lit("streaming"))
    )
    return both.withColumn("marts_last_refreshed_at", F.current_timestamp() if as_of is None else as_of)


MARTS = {
    "daily_trips_summary": daily_trips_summary,
    "hourly_demand_summary": hourly_demand_summary,
    "payment_behavior_summary": payment_behavior_summary,
    "route_performance_summary": route_performance_summary,
    "zone_performance_summary": zone_performance_summary,
}
PARTIALS_OF = {
    "daily_trips_summary": "daily",
    "hourly_demand_summary": "hourly",
    "payment_behavior_summary": "payment",
    "route_performance_summary": "route",
    "zone_performance_summary": "route",
}
