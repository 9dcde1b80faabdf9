"""The monthly batch run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from farelens.functions import derive
from farelens.operators import checks, marts, rules
from farelens.operators.enrich import enrich_trips
from farelens.operators.routing import clean_trips, quarantine_trips, unrouted_trips
from farelens.operators.scorecard import dq_scorecard
from farelens.operators.staging import for_period, stage_trips, stage_zones
from farelens.session import materialize
from farelens.sources.readers import load_schemas, read_trips, read_zones
from farelens.sources.schemas import RAW_TRIP
from farelens.sources.tables import LOAD_PERIOD, read_table, replace_period, upsert, write_mart
from farelens.sources.versions import folder_name, is_versioned, replace_folders

# Accepted codes of the staged trips.
PAYMENT_TYPES = (1, 2, 3, 4)
RATE_CODES = (1, 2, 3, 4, 5)
TRIP_TYPES = (1, 2)
STORE_FLAGS = ("Y", "N")

MART_KEYS = {
    "daily_trips_summary": ("pickup_date", "data_source"),
    "payment_behavior_summary": ("payment_type", "payment_label", "data_source"),
    "zone_performance_summary": ("location_id",),
}

# Tables of partials that are built from one reading of the trips.
PARTIALS_TOGETHER = (("hourly", "daily"), ("route", "payment"))


@dataclass(frozen=True)
class Warehouse:
    """Where the tables are."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def staging_suite(zones: DataFrame) -> list[checks.Check]:
    return [
        *[checks.not_null(c) for c in ("vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id")],
        checks.relationship("pu_location_id", zones, "location_id"),
        checks.relationship("do_location_id", zones, "location_id"),
        checks.accepted_values("payment_type", PAYMENT_TYPES),
        checks.accepted_values("rate_code_id", RATE_CODES),
        checks.accepted_values("trip_type", TRIP_TYPES),
        checks.accepted_values("store_and_fwd_flag", STORE_FLAGS),
    ]


def flagged_suite() -> list[checks.Check]:
    return [
        checks.not_null("vendor_id", severity="warn"),
        checks.not_null("fare_amount"),
        checks.accepted_values("trip_type", TRIP_TYPES),
    ]


def clean_suite() -> list[checks.Check]:
    return [checks.not_null("trip_id"), checks.unique("trip_id")]


def quarantine_suite() -> list[checks.Check]:
    return [checks.not_null("quarantine_reason")]


def scorecard_suite() -> list[checks.Check]:
    return [checks.not_null("rule_name")]


def enriched_suite(zones: DataFrame) -> list[checks.Check]:
    return [
        *[checks.not_null(c) for c in ("trip_id", "vendor_id", "pu_location_id", "do_location_id")],
        checks.unique("trip_id"),
        checks.relationship("pu_location_id", zones, "location_id"),
        checks.relationship("do_location_id", zones, "location_id"),
    ]


def mart_suites() -> dict[str, list[checks.Check]]:
    """Checks per mart; uniqueness is tested on the whole grouping key."""
    first_key = {
        "daily_trips_summary": "pickup_date",
        "hourly_demand_summary": "pickup_date",
        "payment_behavior_summary": "payment_type",
        "route_performance_summary": "pickup_location_id",
        "zone_performance_summary": "location_id",
    }
    return {
        name: [checks.not_null(column), *([checks.unique(*MART_KEYS[name])] if name in MART_KEYS else [])]
        for name, column in first_key.items()
    }


def comparison_suite() -> list[checks.Check]:
    columns = ("data_source", "trip_count", "avg_trip_distance", "avg_fare_amount", "avg_total_amount")
    return [
        *[checks.not_null(c) for c in columns],
        checks.unique("data_source"),
        checks.accepted_values("data_source", ("batch", "streaming")),
    ]


def load_raw(spark: SparkSession, warehouse: Warehouse, period: str, *paths: str) -> None:
    """Load one month's files into the raw table, replacing an earlier load of that month.

    The schemas that the files had are kept beside the table, by load.
    """
    schemas = load_schemas(spark, *paths).withColumn(LOAD_PERIOD, F.lit(period))
    replace_folders(schemas, warehouse.path("raw_taxi_trip_schemas"), LOAD_PERIOD, [folder_name(LOAD_PERIOD, period)], rebalance=False)
    raw = read_trips(spark, *paths)
    raw = raw.withColumn("source_period", derive.month_key(F.col("lpep_pickup_datetime")))
    replace_period(raw, warehouse.path("raw_taxi_trip"), period, ["source_period"])


RAW_TABLE = StructType(
    [*RAW_TRIP.fields, StructField(LOAD_PERIOD, StringType()), StructField("source_period", StringType())]
)


def read_raw(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The raw table; ``source_period`` is a folder, so a period filter reads only its files."""
    return read_table(spark, warehouse.path("raw_taxi_trip"), RAW_TABLE)


def run_period(
    spark: SparkSession,
    period: str,
    trip_paths: Iterable[str],
    zone_path: str,
    warehouse: Warehouse,
    unknown_zones: Iterable[int] = rules.UNKNOWN_ZONES,
    stop_on_failure: bool = True,
    null_policy: str = "sql",
) -> dict:
    """Load, flag, route, enrich and aggregate one month; may be run again for the same month.

    Each layer is checked before the next is built; with ``stop_on_failure`` a failed check ends the
    run. The uniqueness of clean trips is tested before they are merged. Returns row counts and the
    check results.
    """
    results: dict[str, list] = {}

    def check(layer: str, df: DataFrame, suite: list[checks.Check]) -> None:
        outcome = checks.run_checks(df, suite)
        results[layer] = checks.gate(outcome) if stop_on_failure else outcome.collect()

    load_raw(spark, warehouse, period, *trip_paths)
    zones = stage_zones(read_zones(spark, zone_path))
    staged = for_period(stage_trips(read_raw(spark, warehouse)), period)
    check("staging", staged, staging_suite(zones))

    # Stored once: the scorecard, the clean and the quarantine branch all read it.
    repeated = materialize(rules.repeated_keys(staged), "repeated-keys")
    rule_set = rules.validity_rules(unknown_zones)
    flagged = rules.flag_trips(staged, repeated, rule_set, null_policy=null_policy, keep_copies=True)
    flagged = materialize(flagged, "flagged", "is_valid")
    check("flagged", flagged, flagged_suite())

    card, quarantined = dq_scorecard(flagged, period), quarantine_trips(flagged)
    upsert(card, warehouse.path("dq_check_result"), ["reporting_period", "rule_name"], "reporting_period")
    upsert(quarantined, warehouse.path("int_quarantine_trips"), ["trip_id", "dup_seq"], "source_period")
    stored = read_table(spark, warehouse.path("dq_check_result"), card.schema)
    check("scorecard", stored.filter(F.col("reporting_period") == period), scorecard_suite())
    stored = read_table(spark, warehouse.path("int_quarantine_trips"), quarantined.schema)
    check("quarantine", stored.filter(F.col("source_period") == period), quarantine_suite())

    clean = clean_trips(flagged)
    check("clean", clean, clean_suite())
    source = enrich_trips(clean, zones)
    upsert(source, warehouse.path("int_trips_enriched"), ["trip_id"], "source_period")
    enriched = read_table(spark, warehouse.path("int_trips_enriched"), source.schema)
    check("enriched", enriched.filter(F.col("source_period") == period), enriched_suite(zones))

    refresh_marts(enriched, warehouse, period)
    for name, suite in mart_suites().items():
        check(name, spark.read.parquet(warehouse.path(name)), suite)

    by_validity = {r["is_valid"]: r["count"] for r in flagged.groupBy("is_valid").count().collect()}
    return {
        "clean": by_validity.get(True, 0),
        "quarantined": by_validity.get(False, 0),
        "unrouted": unrouted_trips(flagged).count() if None in by_validity else 0,
        "checks": results,
    }


def refresh_comparison(enriched: DataFrame, stream_clean: DataFrame, warehouse: Warehouse) -> None:
    """Rebuild the batch-versus-stream mart."""
    write_mart(marts.batch_streaming_comparison(enriched, stream_clean), warehouse.path("batch_streaming_comparison"))


def update_partials(enriched: DataFrame, warehouse: Warehouse, *periods: str) -> None:
    """Replace the partials of ``periods`` by those of ``enriched``, which holds all trips of these and no others.

    ``enriched`` should be stored: it is read once for each of two grains, whose few groups fold within the tasks. The
    common grain of all marts has about as many groups as there are trips. A period without trips leaves none.
    """
    for names in PARTIALS_TOGETHER:
        grain = dict.fromkeys(("source_period", *[k for name in names for k in marts.PARTIALS[name]]))
        rollup = materialize(marts.rollup_trips(enriched, tuple(grain)), "mart-partials")
        for name in names:
            part = rollup.groupBy("source_period", *marts.PARTIALS[name]).agg(*[F.sum(c).alias(c) for c in marts.partial_names()])
            folders = [folder_name("source_period", p) for p in periods]
            replace_folders(part, warehouse.path(f"partials_{name}"), "source_period", folders, rebalance=len(periods) > 1)


def _partials_schema(enriched: DataFrame, keys: Iterable[str]) -> StructType:
    plan = marts.rollup_trips(enriched, tuple(keys))
    fields = [StructField(f.name, f.dataType) for f in plan.schema.fields]
    return StructType([*fields, StructField("source_period", StringType())])


def refresh_marts(enriched: DataFrame, warehouse: Warehouse, *periods: str) -> None:
    """Bring the five marts up to date after ``periods`` of the enriched trips have changed; all periods if none is named.

    Only trips of these periods are read: their partials are replaced, and the marts are built from the partials of all
    periods.
    """
    if not periods or not is_versioned(enriched.sparkSession, warehouse.path("partials_daily")):
        periods = tuple(r[0] for r in enriched.select("source_period").distinct().collect())  # one row a period
    listed = F.col("source_period").isin([p for p in periods if p is not None])
    chosen = listed | F.col("source_period").isNull() if None in periods else listed
    update_partials(enriched.filter(chosen), warehouse, *periods)
    for name, build in marts.MARTS.items():
        write_mart(build(read_partials(enriched, warehouse, marts.PARTIALS_OF[name])), warehouse.path(name))


def read_partials(enriched: DataFrame, warehouse: Warehouse, name: str) -> DataFrame:
    """The stored partials of all periods at the keys of ``name``."""
    schema = _partials_schema(enriched, marts.PARTIALS[name])
    return read_table(enriched.sparkSession, warehouse.path(f"partials_{name}"), schema)
