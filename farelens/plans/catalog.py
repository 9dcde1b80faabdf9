"""Registered queries: each runs one operator, or one job, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from farelens.functions import derive
from farelens.operators import audit, checks, marts, profile, rules, scorecard
from farelens.operators.enrich import enrich_trips
from farelens.operators.routing import clean_trips, quarantine_trips, unrouted_trips
from farelens.operators.staging import for_period
from farelens.plans.batch import Warehouse, read_partials, staging_suite, update_partials
from farelens.plans.driver_tables import (
    UNKNOWN_NATIONS,
    event_messages,
    raw_trips,
    raw_zones,
    staged_trips,
    staged_zones,
    table,
)
from farelens.session import fresh_path, materialize, use_utc
from farelens.sources.readers import read_event_stream, read_trips, read_zones
from farelens.sources.tables import LOAD_PERIOD, read_table, replace_partitions, replace_period, upsert, write_mart
from farelens.streaming.events import CLEAN, DEAD, QUARANTINE
from farelens.streaming.job import LATE, StreamOptions, run_stream
from farelens.streaming.storage import compact_stream, read_stream_table

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-01-31 00:20:00"
MONTH, EMPTY_MONTH = "1995-03", "2031-01"
PERIOD_START, PERIOD_END = "1996-01-01 00:00:00", "2000-12-31 23:59:59"
STREAM = StreamOptions(unknown_zones=UNKNOWN_NATIONS, trigger={"availableNow": True})
STREAM_WATERMARK = StreamOptions(unknown_zones=UNKNOWN_NATIONS, trigger={"availableNow": True}, dedupe="watermark", watermark="10 days")
STREAM_DEDUPE = StreamOptions(unknown_zones=UNKNOWN_NATIONS, trigger={"availableNow": True}, dedupe="table")


def mean(name: str, places: int = 4) -> Column:
    """Round an average for comparison with another engine.

    Averages of cents often lie exactly between two roundings, where the order of summation would
    decide; the nudge moves them off.
    """
    return F.round(F.col(name) + 10.0 ** -(places + 3), places).alias(name)


def money(name: str) -> Column:
    return F.round(name, 2).alias(name)


def _present(df: DataFrame, *drop: str) -> DataFrame:
    """Times and dates as text, audit times left out."""
    shown = []
    for f in df.schema.fields:
        if f.name in ("_loaded_at", "run_at", "dq_checked_at", "marts_last_refreshed_at", *drop):
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd").alias(f.name)
        shown.append(c)
    return df.select(*shown)


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round sums of money to cents and averages to four places."""
    out = []
    for c in df.columns:
        if c in places:
            out.append(mean(c, places[c]))
        elif c.startswith("avg_"):
            out.append(mean(c))
        elif c in ("total_revenue", "total_tip_amount"):
            out.append(money(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _rules() -> list[rules.Rule]:
    return rules.validity_rules(UNKNOWN_NATIONS)


def _flagged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    trips = staged_trips(spark, d)
    repeated = materialize(rules.repeated_keys(trips), "repeated-keys")
    return rules.flag_trips(trips, repeated, _rules(), keep_copies=True), repeated


def _quarantined(spark: SparkSession, d: str) -> DataFrame:
    # Stored as in the monthly run, since the rows are read three times.
    flagged, _ = _flagged(spark, d)
    return quarantine_trips(materialize(flagged.filter("is_valid = false"), "flagged"))


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich_trips(clean_trips(_flagged(spark, d)[0]), staged_zones(spark, d))


def _mart(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: _rounded(_present(build(_enriched(spark, d))), tip_rate=6)


def _scorecard(spark: SparkSession, d: str) -> DataFrame:
    # The scorecard needs the row rules only, so no duplicate search is planned for it.
    return _present(scorecard.dq_scorecard(rules.apply_rules(staged_trips(spark, d), _rules())))


def _comparison(spark: SparkSession, d: str) -> DataFrame:
    """Both sides as committed: the upserted trips and the table that the stream wrote."""
    enriched, path = _enriched(spark, d), fresh_path(spark, "enriched-trips")
    upsert(enriched, path, ["trip_id"], "source_period")
    stream = read_stream_table(spark, _streamed(spark, d), CLEAN)
    return _present(marts.batch_streaming_comparison(read_table(spark, path, enriched.schema), stream))


def _scorecard_of_periods(spark: SparkSession, d: str) -> DataFrame:
    """The run of one month and of a month without trips."""
    ruled = rules.apply_rules(staged_trips(spark, d), _rules())
    cards = [scorecard.dq_scorecard(for_period(ruled, p), p) for p in (MONTH, EMPTY_MONTH)]
    return _present(cards[0].unionByName(cards[1]))


def _flag_period(spark: SparkSession, d: str) -> DataFrame:
    trips = for_period(staged_trips(spark, d), MONTH)
    repeated = materialize(rules.repeated_keys(trips), "repeated-keys")
    return _present(rules.flag_trips(trips, repeated, _rules()))


def _ts(text: str) -> Column:
    return F.to_timestamp(F.lit(text))


def _named_zones(spark: SparkSession, d: str) -> DataFrame:
    return staged_zones(spark, d).filter("borough is not null")


def _zones_csv(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "zones")
    raw_zones(spark, d).write.option("header", True).csv(path)
    return read_zones(spark, path)


def _trips_files(spark: SparkSession, d: str) -> DataFrame:
    """The trips as files of three schemas, by year: one without the late fee and with floating counts, one narrower."""
    path, trips = fresh_path(spark, "trip-files"), raw_trips(spark, d)
    year = F.year("lpep_pickup_datetime")
    old = trips.filter(year < 1995).drop("cbd_congestion_fee").withColumn("passenger_count", F.col("passenger_count").cast("double"))
    middle = trips.filter((year >= 1995) & (year < 1997)).withColumn("VendorID", F.col("VendorID").cast("int")).drop("ehail_fee")
    for name, part in (("a", old), ("b", middle), ("c", trips.filter(year >= 1997))):
        part.write.parquet(f"{path}/{name}")
    return _present(read_trips(spark, *[f"{path}/{name}" for name in "abc"]))


def _unmatched_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of both severities, passed and failed."""
    suite = [
        checks.not_null("vendor_id", severity="warn"),
        checks.not_null("rate_code_id", severity="warn"),
        checks.not_null("trip_distance"),
        checks.accepted_values("payment_type", (1, 2, 3, 4), severity="warn"),
        checks.unique("vendor_id", "pickup_datetime", severity="warn"),
        checks.relationship("pu_location_id", _named_zones(spark, d), "location_id", severity="warn"),
    ]
    return checks.run_checks(staged_trips(spark, d), suite)


def _write_mart(spark: SparkSession, d: str) -> DataFrame:
    """A mart written over an older one of other rows, and read back."""
    path, mart = fresh_path(spark, "mart"), marts.daily_trips_summary(_enriched(spark, d))
    write_mart(mart.limit(3), path)
    write_mart(mart, path)
    return _rounded(_present(read_table(spark, path, mart.schema)))


def _incremental_mart(name: str) -> Query:
    """The mart from stored partials: of all months, then of some months whose trips had been left out at first."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        used = dict.fromkeys(("source_period", "vendor_id", *marts.MART_GRAIN, *marts.MEASURES))
        enriched = materialize(_enriched(spark, d).select(*used), "enriched-trips")
        warehouse = Warehouse(fresh_path(spark, "warehouse"))
        months = [r[0] for r in enriched.select("source_period").distinct().collect()]
        late = sorted(months)[::12]
        update_partials(enriched.filter(~F.col("source_period").isin(late) | (F.col("vendor_id") < 3)), warehouse, *months)
        update_partials(enriched.filter(F.col("source_period").isin(late)), warehouse, *late)
        partials = read_partials(enriched, warehouse, marts.PARTIALS_OF[name])
        return _rounded(_present(marts.MARTS[name](partials)), tip_rate=6)

    return query


def _order_trips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        derive.month_key(F.col("o_orderdate")).alias("source_period"),
        F.date_format("o_orderdate", "yyyy").alias("load_year"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
    )


def _upsert(spark: SparkSession, d: str) -> DataFrame:
    """Finished and open orders are stored; then open and pending ones arrive with a new amount."""
    trips = _order_trips(spark, d).drop("load_year")
    path = fresh_path(spark, "upsert-table")
    upsert(trips.filter("status in ('F', 'O')").drop("status"), path, ["trip_id"], "source_period")
    changed = trips.filter("status in ('O', 'P')").drop("status").withColumn("total_amount", F.col("total_amount") + 1)
    upsert(changed, path, ["trip_id"], "source_period")
    return read_table(spark, path, StructType.fromDDL("trip_id bigint, total_amount double, source_period string"))


def _replace_period(spark: SparkSession, d: str) -> DataFrame:
    """All years are loaded; then 1997 is loaded again with a new amount."""
    trips = _order_trips(spark, d).drop("status", "source_period").withColumnRenamed("load_year", LOAD_PERIOD)
    path = fresh_path(spark, "period-table")
    replace_partitions(trips, path, LOAD_PERIOD)
    changed = trips.filter(f"{LOAD_PERIOD} = '1997'").withColumn("total_amount", F.col("total_amount") + 1)
    replace_period(changed.drop(LOAD_PERIOD), path, "1997", cluster_by=["trip_id"])
    stored = spark.read.schema(f"trip_id bigint, total_amount double, {LOAD_PERIOD} string").parquet(path)
    return stored.withColumnRenamed(LOAD_PERIOD, "load_year")


def _streamed(spark: SparkSession, d: str, options: StreamOptions = STREAM, times: int = 1) -> str:
    """Run the job over all messages as text files, each time delivered anew; returns the folder of the tables."""
    source, out, state = (fresh_path(spark, n) for n in ("messages", "stream-tables", "stream-state"))
    messages = event_messages(spark, d).select("value")
    messages = materialize(messages, "event-messages") if times > 1 else messages
    for _ in range(times):
        messages.write.mode("append").text(source)
        run_stream(read_event_stream(spark, source), out, state, options).awaitTermination()
    return out


EVENT_OUT = (
    "event_id event_time vendor_id rate_code_id passenger_count trip_type payment_type store_and_fwd_flag pu_location_id "
    "do_location_id trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge "
    "congestion_surcharge cbd_congestion_fee total_amount pickup_datetime dropoff_datetime"
).split()
CLEAN_OUT = [
    *EVENT_OUT,
    *(
        "pickup_date pickup_hour pickup_day_name is_weekend trip_duration_minutes time_period "
        "payment_label store_and_fwd_flag_label _data_source"
    ).split(),
]
QUARANTINE_OUT = [*EVENT_OUT, "is_valid", *rules.RULE_NAMES, "amount_mismatch", "quarantine_reason", "_data_source"]


def _stream_table(name: str, columns: list[str]) -> Query:
    return lambda spark, d: _present(read_stream_table(spark, _streamed(spark, d), name).select(*columns))


def _stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """All messages are delivered twice: good and bad trips are stored once, dead letters each time."""
    out = _streamed(spark, d, STREAM_DEDUPE, 2)
    parts = [
        read_stream_table(spark, out, t).select(F.lit(t).alias("stored_in"), "event_id", F.round("total_amount", 2).alias("total_amount"), F.lit(None).cast("string").alias("error"))
        for t in (CLEAN, QUARANTINE)
    ]
    dead = read_stream_table(spark, out, DEAD).select(F.lit(DEAD).alias("stored_in"), F.col("value").alias("event_id"), F.lit(None).cast("double").alias("total_amount"), "error")
    return parts[0].unionByName(parts[1]).unionByName(dead)


def _stream_dedupe_watermark(spark: SparkSession, d: str) -> DataFrame:
    """All messages are delivered twice; the second time, those older than the watermark are late."""
    out = _streamed(spark, d, STREAM_WATERMARK, 2)
    ids = [read_stream_table(spark, out, t).select(F.lit(t).alias("stored_in"), "event_id", F.lit(None).cast("string").alias("error")) for t in (CLEAN, QUARANTINE)]
    dead = read_stream_table(spark, out, DEAD)
    late = F.when(F.col("error") == LATE, F.get_json_object("value", "$.event_id")).otherwise(F.col("value"))
    return ids[0].unionByName(ids[1]).unionByName(dead.select(F.lit(DEAD).alias("stored_in"), late.alias("event_id"), "error"))


def _stream_compact(spark: SparkSession, d: str) -> DataFrame:
    """All messages are delivered twice, in batches of their own; the tables are compacted after each."""
    source, out, state = (fresh_path(spark, n) for n in ("messages", "stream-tables", "stream-state"))
    messages = materialize(event_messages(spark, d).select("value"), "event-messages")
    for _ in range(3):
        messages.write.mode("append").text(source)
        run_stream(read_event_stream(spark, source), out, state, STREAM).awaitTermination()
        for table in (CLEAN, QUARANTINE, DEAD):
            compact_stream(spark, out, table)
    parts = [read_stream_table(spark, out, t).select(F.lit(t).alias("stored_in"), F.col(key).alias("event_id")) for t, key in ((CLEAN, "event_id"), (QUARANTINE, "event_id"), (DEAD, "value"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("stored_in", "event_id").agg(F.count(F.lit(1)).alias("n_rows"))


def _freshness(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumnRenamed("ts", "ingestion_time")
    return _rounded(_present(scorecard.freshness(events, now=_ts(NOW))), age_minutes=4)


def _describe_times(spark: SparkSession, d: str) -> DataFrame:
    described = profile.describe_times(raw_trips(spark, d))
    between = [F.unix_seconds(c).alias(c) for c in ("mean", "p25", "p50", "p75")]
    return _present(described.select("column", "count", *between, "min", "max"))


def _trip_text() -> Column:
    """A raw trip as text that another engine writes the same way: times in seconds, money in cents."""
    seconds = [F.expr(f"unix_micros(cast({c} as timestamp)) div 1000000") for c in ("lpep_pickup_datetime", "lpep_dropoff_datetime")]
    codes = [F.col(c) for c in ("VendorID", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "payment_type", "trip_type")]
    cents = [F.floor(F.col(c) * 100 + 0.5) for c in ("fare_amount", "total_amount")]
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in (*seconds, *codes, *cents)])


def _stored_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw trips, stored: each part of a profile reads them again."""
    return materialize(raw_trips(spark, d), "raw-trips")


def _profile_rows(spark: SparkSession, d: str) -> DataFrame:
    """The profile, written by section and read back."""
    path = fresh_path(spark, "profile")
    profile.write_profile(profile.profile_rows(_stored_raw(spark, d), _trip_text()), path)
    rows = spark.read.schema("name string, key string, value double, section string").json(path)
    return rows.withColumn("value", F.round(F.col("value") + 1e-9, 6))


def _profile_document(spark: SparkSession, d: str) -> DataFrame:
    """The nested profile, written by section and read back; values as text, as engines write numbers differently."""
    path = fresh_path(spark, "profile-document")
    text = F.format_string("%.6f", F.col("value") + F.lit(1e-9))
    rows = materialize(profile.profile_rows(_stored_raw(spark, d), _trip_text()), "profile-rows").withColumn("value", text)
    profile.write_profile_document(rows, path)
    return spark.read.schema("name string, part string, document string, section string").json(path)


def _percent(df: DataFrame) -> DataFrame:
    return df.withColumn("percentage", F.round(F.col("percentage") + 1e-6, 2))


def _registered() -> dict[str, Query]:
    def raw(fn: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, d: fn(raw_trips(spark, d))

    def staged(fn: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, d: _present(fn(staged_trips(spark, d)))

    def flagged(fn: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, d: _present(fn(_flagged(spark, d)[0]), "n_copies")

    described = dict.fromkeys(("mean", "std", "median", "p25", "p50", "p75"), 4)
    return {
        "dq_scorecard": _scorecard,
        "stage_trips": staged(lambda df: df),
        "stage_zones": staged_zones,
        "read_zones_csv": _zones_csv,
        "flag_trips": flagged(lambda df: df),
        "clean_trips": flagged(clean_trips),
        "unrouted_trips": flagged(unrouted_trips),
        "quarantine_trips": lambda spark, d: _present(_quarantined(spark, d)),
        "quarantine_reasons": lambda spark, d: scorecard.quarantine_reasons(_flagged(spark, d)[0].filter("is_valid = false")),
        "enrich_trips": lambda spark, d: _present(_enriched(spark, d)),
        **{name: _mart(build) for name, build in marts.MARTS.items()},
        "batch_streaming_comparison": _comparison,
        "hour_distribution": lambda spark, d: _rounded(
            profile.hour_distribution(table(spark, d, "events"), "ts"), probability=6
        ),
        "category_distribution": raw(lambda df: _rounded(profile.category_distribution(df), probability=8)),
        "ratio_percentiles": raw(lambda df: _rounded(profile.ratio_percentiles(df), value=6)),
        "reference_sample": lambda spark, d: profile.reference_sample(
            table(spark, d, "events"), "value", F.col("event_id"), n=5000
        ),
        "profile_rows": _profile_rows,
        "profile_document": _profile_document,
        "table_shape": raw(profile.table_shape),
        "missing_summary": raw(lambda df: _rounded(profile.missing_summary(df), percentage=4)),
        "distinct_counts": raw(profile.distinct_counts),
        "duplicate_rows": raw(profile.duplicate_rows),
        "describe_numeric": raw(lambda df: _rounded(profile.describe_numeric(df), **described)),
        "describe_times": _describe_times,
        "fare_summary": raw(lambda df: _rounded(profile.fare_summary(df), **described)),
        "value_counts": raw(
            lambda df: _percent(
                profile.value_counts(
                    df, ("VendorID", "RatecodeID", "store_and_fwd_flag", "payment_type", "trip_type", "passenger_count")
                )
            )
        ),
        "top_values": raw(lambda df: _percent(profile.top_values(df, "PULocationID", 5))),
        "out_of_period": raw(lambda df: audit.out_of_period(df, _ts(PERIOD_START), _ts(PERIOD_END))),
        "out_of_period_rows": raw(
            lambda df: _present(
                audit.out_of_period_rows(df, _ts(PERIOD_START), _ts(PERIOD_END)).select(
                    "lpep_pickup_datetime", "lpep_dropoff_datetime"
                )
            )
        ),
        "anomaly_counts": raw(audit.anomaly_counts),
        "suspicious_trips": raw(audit.suspicious_trips),
        "mismatch_count": raw(audit.mismatch_count),
        "location_audit": raw(lambda df: audit.location_audit(df, UNKNOWN_NATIONS)),
        "location_bounds": raw(audit.location_bounds),
        "audit_unmatched": lambda spark, d: audit.audit_unmatched(raw_trips(spark, d), raw_zones(spark, d)),
        "check_not_null": staged(lambda df: checks.check_not_null(df, "rate_code_id")),
        "check_unique": lambda spark, d: checks.check_unique(
            staged_trips(spark, d).select(derive.trip_key().alias("trip_id")), "trip_id"
        ),
        "check_accepted_values": staged(lambda df: checks.check_accepted_values(df, "payment_type", (1, 2, 3, 4))),
        "check_relationship": lambda spark, d: checks.check_relationship(
            staged_trips(spark, d), "pu_location_id", _named_zones(spark, d), "location_id"
        ),
        "run_checks": lambda spark, d: checks.run_checks(staged_trips(spark, d), staging_suite(_named_zones(spark, d))),
        "run_checks_warn": _unmatched_checks,
        "read_trips_files": _trips_files,
        "write_mart": _write_mart,
        **{f"incremental_{name}": _incremental_mart(name) for name in ("hourly_demand_summary", "zone_performance_summary")},
        "upsert_trips": _upsert,
        "replace_period": _replace_period,
        "stream_clean": _stream_table(CLEAN, CLEAN_OUT),
        "stream_quarantine": _stream_table(QUARANTINE, QUARANTINE_OUT),
        "stream_dead_letter": _stream_table(DEAD, ["value", "error"]),
        "stream_dedupe": _stream_dedupe,
        "stream_dedupe_watermark": _stream_dedupe_watermark,
        "stream_compact": _stream_compact,
        "dq_scorecard_period": _scorecard_of_periods,
        "flag_period": _flag_period,
        "freshness": _freshness,
    }


def queries() -> dict[str, Query]:
    def in_utc(query: Query) -> Query:
        return lambda spark, d: query(use_utc(spark), d)

    return {name: in_utc(query) for name, query in _registered().items()}
