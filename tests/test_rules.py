from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelens.operators import rules
from farelens.operators.routing import clean_trips, quarantine_trips, unrouted_trips
from farelens.operators.staging import for_period, stage_trips
from farelens.session import materialize
from tests.rows import GOOD, trips


def flag(spark, *changes, **options):
    return rules.flag_trips(stage_trips(trips(spark, *changes)), **options)


def route(flagged):
    return flagged.select("is_valid", "quarantine_reason", "amount_mismatch").first()


CASES = [
    ({}, (True, ""), (True, "")),
    ({"trip_distance": None}, (None, ""), (False, "invalid_distance")),
    ({"trip_distance": float("nan")}, (False, "invalid_distance"), (False, "invalid_distance")),
    ({"trip_distance": -1.0}, (False, "invalid_distance"), (False, "invalid_distance")),
    ({"passenger_count": None}, (False, "incomplete_record"), (False, "incomplete_record, invalid_passenger_count")),
    ({"passenger_count": 0}, (False, "invalid_passenger_count"), (False, "invalid_passenger_count")),
    ({"PULocationID": None, "DOLocationID": 265}, (False, "invalid_location"), (False, "invalid_location")),
    ({"PULocationID": None}, (None, ""), (False, "invalid_location")),
    ({"DOLocationID": 264}, (False, "invalid_location"), (False, "invalid_location")),
    ({"total_amount": None}, (None, ""), (False, "invalid_fare")),
    ({"fare_amount": None, "total_amount": -1.0}, (False, "invalid_fare"), (False, "invalid_fare")),
    (
        {"VendorID": None, "trip_distance": -1.0, "fare_amount": -1.0, "passenger_count": 0, "PULocationID": 264},
        (False, "incomplete_record, invalid_distance, invalid_fare, invalid_passenger_count, invalid_location"),
        (False, "incomplete_record, invalid_distance, invalid_fare, invalid_passenger_count, invalid_location"),
    ),
]


@pytest.mark.parametrize("change, sql, strict", CASES)
def test_rules_under_both_null_policies(spark, change, sql, strict):
    assert tuple(route(flag(spark, change)))[:2] == sql
    assert tuple(route(flag(spark, change, null_policy="strict")))[:2] == strict


def test_mismatch_is_informational_and_in_cents(spark):
    assert tuple(route(flag(spark, {"total_amount": 17.26}))) == (True, "", True)
    assert tuple(route(flag(spark, {"total_amount": 17.250001}))) == (True, "", False)
    assert route(flag(spark, {"total_amount": None}))["amount_mismatch"] is None
    assert route(flag(spark, {"total_amount": None}, null_policy="strict"))["amount_mismatch"] is True


def test_missing_component_counts_as_zero(spark):
    row = flag(spark, {"extra": None, "total_amount": 16.25}).first()
    assert row["total_amount_recomputed"] == 16.25 and row["amount_mismatch"] is False


def test_component_lists_differ_by_the_late_fee(spark):
    change = {"cbd_congestion_fee": 0.75, "total_amount": 18.0}
    assert route(flag(spark, change))["amount_mismatch"] is False
    assert route(flag(spark, change, components=rules.STREAM_COMPONENTS))["amount_mismatch"] is True


def test_every_copy_is_a_duplicate(spark):
    flagged = flag(spark, {}, {"fare_amount": 11.0, "total_amount": 18.25}, {"VendorID": 1})
    assert sorted(r["quarantine_reason"] for r in flagged.collect()) == ["", "duplicate", "duplicate"]


def test_null_keys_are_equal_in_the_duplicate_rule(spark):
    flagged = flag(spark, {"PULocationID": None}, {"PULocationID": None})
    assert [r["is_duplicate"] for r in flagged.collect()] == [True, True]


def test_ambiguous_keys_without_separator(spark):
    pair = ({"PULocationID": 1, "DOLocationID": 12}, {"PULocationID": 11, "DOLocationID": 2})
    apart = flag(spark, *pair)
    together = flag(spark, *pair, key_sep="")
    assert apart.select("trip_id").distinct().count() == 2
    assert together.select("trip_id").distinct().count() == 1
    assert apart.filter("is_duplicate").count() == together.filter("is_duplicate").count() == 0


def test_routes_cover_all_rows_once(spark):
    flagged = flag(spark, *[{**c, "VendorID": c.get("VendorID", 100 + i)} for i, (c, _, _) in enumerate(CASES)])
    n = flagged.count()
    bad = flagged.filter("is_valid = false").count()
    assert clean_trips(flagged).count() + bad + unrouted_trips(flagged).count() == n == len(CASES)


def test_clean_trips_have_no_flag_columns(spark):
    flagged = flag(spark, {}, keep_copies=True)
    assert len(clean_trips(flagged).columns) == 24
    assert len(flag(spark, {}).columns) == 34


def quarantined(spark, changes):
    staged = stage_trips(trips(spark, *changes))
    repeated = materialize(rules.repeated_keys(staged), "test-repeated")
    flagged = rules.flag_trips(staged, repeated, keep_copies=True)
    return quarantine_trips(flagged)


# Copies, ties in fare, ties in fare and distance, missing fares, two groups.
DUPLICATES = (
    [{"tip_amount": float(i % 7)} for i in range(60)]
    + [{"fare_amount": float(i % 5), "trip_distance": float(i % 3)} for i in range(60)]
    + [{"fare_amount": None}] * 9
    + [{}] * 40
    + [{"VendorID": 1, "fare_amount": -float(i)} for i in range(30)]
    + [{"VendorID": 1, "passenger_count": 0}]
)


def test_numbers_equal_those_of_a_window(spark):
    large = quarantined(spark, DUPLICATES).drop("_loaded_at", "dq_checked_at")
    order = ["fare_amount", "trip_distance"]
    order += [c for c in large.columns if c not in (*order, "trip_id", "dup_seq")]
    window = Window.partitionBy("trip_id").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    wrong = large.withColumn("want", F.row_number().over(window)).groupBy("trip_id", *order).agg(
        F.sort_array(F.collect_list(F.col("want").cast("bigint"))).alias("want"), F.sort_array(F.collect_list("dup_seq")).alias("got")
    )
    assert wrong.filter("want <> got").count() == 0
    per_key = large.groupBy("trip_id").agg(
        F.count("*").alias("n"), F.count_distinct("dup_seq").alias("d"), F.min("dup_seq").alias("lo"), F.max("dup_seq").alias("hi")
    )
    assert [r for r in per_key.collect() if not (r["n"] == r["d"] == r["hi"] and r["lo"] == 1)] == []
    assert large.count() == len(DUPLICATES)


def test_numbers_of_colliding_keys(spark):
    """Rows of different key columns under one trip_id: (trip_id, dup_seq) is unique all the same."""
    staged = stage_trips(trips(spark, *DUPLICATES))
    flagged = rules.flag_trips(staged, materialize(rules.repeated_keys(staged), "test-repeated"), keep_copies=True)
    out = quarantine_trips(flagged.withColumn("trip_id", F.lit("one")))
    assert sorted(r["dup_seq"] for r in out.collect()) == list(range(1, out.count() + 1))


def test_copies_unfold_over_several_blocks(spark, monkeypatch):
    from farelens.operators import numbering

    monkeypatch.setattr(numbering, "COPY_BLOCK", 7)
    df = spark.createDataFrame([("a", 1)] * 50 + [("a", 2)] * 3 + [("b", 1)], "g string, v int")
    out = numbering.number_by_ranges(df, ["g"], ["v"], "n").collect()
    assert sorted((r["g"], r["n"], r["v"]) for r in out) == sorted(
        [("a", i + 1, 1) for i in range(50)] + [("a", 51 + i, 2) for i in range(3)] + [("b", 1, 1)]
    )


def test_numbers_order_missing_fares_first(spark):
    rows = quarantined(spark, [{"fare_amount": 3.0}, {"fare_amount": None}, {"fare_amount": -1.0}]).collect()
    assert [r["fare_amount"] for r in sorted(rows, key=lambda r: r["dup_seq"])] == [None, -1.0, 3.0]


def test_period_filter_is_half_open(spark):
    from datetime import datetime

    times = [datetime(2026, 3, 31, 23, 59, 59), datetime(2026, 4, 1), datetime(2026, 4, 30, 23, 59, 59), datetime(2026, 5, 1)]
    staged = stage_trips(trips(spark, *[{"lpep_pickup_datetime": t} for t in times]))
    assert for_period(staged, "2026-04").count() == 2


def test_events_have_no_duplicate_rule_and_null_reason(spark):
    events = stage_trips(trips(spark, {}, {}, {"trip_distance": None}))
    rows = rules.flag_events(events).select("is_valid", "quarantine_reason").collect()
    assert sorted((r[0], r[1] or "") for r in rows) == [(False, "invalid_distance"), (True, ""), (True, "")]
    assert [r[1] for r in rows if r[0]] == [None, None]


def test_good_trip_is_consistent():
    parts = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge"]
    assert sum(GOOD[p] for p in parts) == GOOD["total_amount"]
    assert GOOD["lpep_dropoff_datetime"] - GOOD["lpep_pickup_datetime"] == timedelta(minutes=30)
