import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelens.operators import audit, profile
from farelens.operators.percentiles import exact_percentiles
from tests.rows import trips

QS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def values_frame(spark, values, parts=6):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)


def distributions():
    rng = random.Random(7)
    yield "uniform", [rng.random() for _ in range(5000)]
    yield "one value holds a third", [1.5] * 2000 + [rng.gauss(0, 100) for _ in range(4000)]
    yield "long tail", [rng.paretovariate(0.5) for _ in range(5000)]
    yield "all equal", [3.0] * 1000
    yield "two values", [1.0] * 500 + [2.0] * 500
    yield "signs and zeros", [-7.5, -1.0, 0.0, -0.0, 5.0] * 30
    yield "single", [4.25]


@pytest.mark.parametrize("name, values", list(distributions()), ids=[n for n, _ in distributions()])
@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_percentiles_equal_numpy(spark, name, values, ranges):
    found = exact_percentiles(values_frame(spark, values), {"x": F.col("x")}, QS, ranges)
    got = {r["quantile"]: r["value"] for r in found.collect()}
    for q in QS:
        assert got[q] == pytest.approx(float(np.quantile(np.array(values), q)), rel=1e-12, abs=1e-12)


def test_percentiles_of_several_columns_with_missing_values(spark):
    rng = random.Random(3)
    rows = [(rng.random() if i % 3 else None, float(i % 50), None) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    exprs = {n: F.col(n) for n in "abc"}
    direct = {(r[0], r[1]): r[2] for r in exact_percentiles(df, exprs, QS).collect()}
    narrowed = {(r[0], r[1]): r[2] for r in exact_percentiles(df, exprs, QS, ranges=30).collect()}
    assert direct.keys() == narrowed.keys() and len(direct) == 3 * len(QS)
    for key, value in direct.items():
        assert narrowed[key] == (None if value is None else pytest.approx(value, rel=1e-12))
    assert direct["c", 0.5] is None


def test_approximate_percentiles_are_close(spark):
    df = spark.range(10001).select((F.col("id") * 1.0).alias("x"))
    rows = profile.ratio_percentiles_approx(df, {"x": F.col("x")}).collect()
    assert [r["stat"] for r in rows] == ["p10", "median", "p90"]
    assert [r["value"] for r in rows] == pytest.approx([1000, 5000, 9000], abs=3)


def test_ratios_are_guarded(spark):
    df = trips(
        spark,
        {"trip_distance": 2.0, "fare_amount": 8.0, "tip_amount": 2.0},
        {"trip_distance": 0.0, "fare_amount": 8.0, "tip_amount": 0.0},
        {"trip_distance": -1.0, "fare_amount": -8.0, "tip_amount": 1.0},
        {"trip_distance": None, "fare_amount": None, "tip_amount": None},
    )
    rows = {r["name"]: r["value"] for r in profile.ratio_percentiles(df).filter("stat = 'median'").collect()}
    assert rows == {"fare_per_mile": 4.0, "tip_per_fare": 0.25, "speed_distribution": 4.0}


def test_hours_are_dense_and_ignore_missing_times(spark):
    df = trips(spark, {}, {}, {"lpep_pickup_datetime": None})
    rows = {r["hour"]: r["probability"] for r in profile.hour_distribution(df).collect()}
    assert len(rows) == 24 and rows[8] == 1.0 and sum(rows.values()) == 1.0
    assert all(r["probability"] == 0.0 for r in profile.hour_distribution(df.filter("false")).collect())


def test_category_distribution_has_null_key(spark):
    df = trips(spark, {}, {"RatecodeID": None}, {"RatecodeID": None}, {"extra": float("nan")})
    rows = {(r["column"], r["value"]): r["probability"] for r in profile.category_distribution(df).collect()}
    assert rows["RatecodeID", "null"] == 0.5 and rows["RatecodeID", "1"] == 0.5
    assert rows["extra", "1.0"] == 0.75 and rows["extra", "null"] == 0.25
    assert {c for c, _ in rows} == set(profile.PROFILED_COLUMNS)


def test_sample_is_the_smallest_digests_on_any_partitioning(spark):
    df = spark.range(50_000).select("id", (F.col("id") * 1.0).alias("x"))
    one = {r["value"] for r in profile.reference_sample(df, "x", F.col("id"), n=500).collect()}
    other = {r["value"] for r in profile.reference_sample(df.repartition(13), "x", F.col("id"), n=500).collect()}
    digest = F.md5(F.concat_ws("-", F.lit("42"), F.col("id").cast("string")))
    whole = {r["x"] for r in df.orderBy(digest).limit(500).collect()}
    assert one == other == whole and len(one) == 500
    assert {r["value"] for r in profile.reference_sample(df, "x", F.col("id"), n=500, seed=7).collect()} != one


def test_sample_takes_all_if_few_and_skips_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert [r["value"] for r in profile.reference_sample(df, "x", F.col("id")).collect()] == [1.0]


def test_sample_without_key_is_the_same_on_any_partitioning(spark):
    df = spark.range(5000).select((F.col("id") % 1000 * 1.0).alias("x"), F.lit("same").alias("y"))
    first = [r["value"] for r in profile.reference_sample(df, "x", n=700).collect()]
    again = [r["value"] for r in profile.reference_sample(df.repartition(7), "x", n=700).collect()]
    assert len(first) == 700 and sorted(first) == sorted(again)
    copies = spark.range(3000).select(F.lit(1.5).alias("x"))
    assert profile.reference_sample(copies, "x", n=50).count() == 50


def test_missing_distinct_and_duplicates(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "a"), (1, -0.0, "a"), (2, float("nan"), None), (2, None, None), (2, None, None), (2, None, None)],
        "i int, f double, s string",
    )
    missing = {r["column"]: (r["missing_values"], round(r["percentage"], 2)) for r in profile.missing_summary(df).collect()}
    assert missing == {"f": (4, 66.67), "s": (4, 66.67), "i": (0, 0.0)}
    assert {r["column"]: r["unique_values"] for r in profile.distinct_counts(df).collect()} == {"i": 2, "f": 1, "s": 1}
    assert profile.duplicate_rows(df).first()["duplicate_rows"] == 3
    assert profile.duplicate_rows(df.filter("false")).first()["duplicate_rows"] == 0
    assert profile.table_shape(df).first()[:2] == (6, 3)
    approx = {r["column"]: r["unique_values"] for r in profile.distinct_counts(df, approximate=True).collect()}
    assert approx["i"] == 2


def test_describe(spark):
    df = trips(spark, *[{"fare_amount": float(v)} for v in (1, 2, 3, 4, 10)], {"fare_amount": None})
    fare = {r["column"]: r for r in profile.describe_numeric(df).collect()}["fare_amount"]
    assert (fare["count"], fare["mean"], fare["min"], fare["p25"], fare["p50"], fare["p75"], fare["max"]) == (5, 4, 1, 2, 3, 4, 10)
    assert fare["std"] == pytest.approx(np.std([1, 2, 3, 4, 10], ddof=1))
    row = {r["column"]: r for r in profile.fare_summary(df).collect()}["fare_amount"]
    assert (row["count"], row["mean"], row["median"], row["min"], row["max"]) == (5, 4, 3, 1, 10)
    times = {r["column"]: r for r in profile.describe_times(df).collect()}["lpep_pickup_datetime"]
    assert times["count"] == 6 and times["p50"] == times["min"] == times["max"] == times["mean"]


def test_value_counts_and_top_values(spark):
    df = trips(spark, {"PULocationID": 5}, {"PULocationID": 5}, {"PULocationID": 7}, {"PULocationID": None})
    rows = [tuple(r) for r in profile.value_counts(df, ["PULocationID"]).collect()]
    assert rows == [("PULocationID", "5", 2, 50.0), ("PULocationID", "7", 1, 25.0), ("PULocationID", None, 1, 25.0)]
    assert [tuple(r) for r in profile.top_values(df, "PULocationID", 2).collect()] == [(5, 2, 50.0), (7, 1, 25.0)]


def test_profile_document(spark, tmp_path):
    df = trips(spark, {}, {"trip_distance": 5.0}, {"RatecodeID": None})
    rows = profile.profile_rows(df)
    found = {(r["section"], r["name"]): json.loads(r["document"]) for r in profile.profile_document(rows).collect()}
    hours = found["hour_distribution", ""]
    assert hours["8"] == 1.0 and len(hours) == 24
    assert found["trip_distance_values", ""] == [3.0, 3.0, 5.0]
    assert set(found["fare_per_mile", ""]) == {"p10", "median", "p90"}
    assert found["category_distribution", "RatecodeID"] == {"1": pytest.approx(2 / 3), "null": pytest.approx(1 / 3)}
    assert {name for section, name in found if section == "category_distribution"} == set(profile.PROFILED_COLUMNS)
    profile.write_profile(rows, str(tmp_path / "p"))
    back = spark.read.schema("name string, key string, value double, section string").json(str(tmp_path / "p"))
    assert back.count() == rows.count()
    profile.write_profile_document(rows, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == len(found)


def test_large_sections_are_split_into_parts(spark):
    rows = spark.range(5000).select(
        F.lit("category_distribution").alias("section"), F.lit("c").alias("name"), F.col("id").cast("string").alias("key"), (F.col("id") * 1.0).alias("value")
    )
    parts = profile.profile_document(rows, entries=100).collect()
    whole = {}
    for r in parts:
        piece = json.loads(r["document"])
        assert len(piece) < 100 and not whole.keys() & piece.keys()
        whole |= piece
    assert whole == {str(k): float(k) for k in range(5000)} and len(parts) == 256
    assert profile.profile_document(rows.filter("false")).count() == 0


def test_summaries_read_their_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).select((F.col("id") % 7 * 1.0).alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    for described in (profile.describe_numeric(df), profile.top_values(df, "x"), profile.value_counts(df, ["x"])):
        assert path not in described._jdf.queryExecution().executedPlan().toString()  # only stored folds are left to read


def test_audit(spark):
    from datetime import datetime

    start = datetime(2026, 4, 10, 8)
    df = trips(
        spark,
        {},
        {"trip_distance": 0.0, "lpep_dropoff_datetime": start},
        {"trip_distance": 0.0, "lpep_dropoff_datetime": datetime(2026, 4, 10, 7), "total_amount": -1.0},
        {"trip_distance": -1.0, "passenger_count": 0, "payment_type": 2},
        {"extra": None, "passenger_count": None, "cbd_congestion_fee": None, "PULocationID": 265},
        {"lpep_pickup_datetime": datetime(2026, 6, 1), "PULocationID": 264, "DOLocationID": 265},
        {"PULocationID": None, "DOLocationID": 1},
    )
    counts = {r["check"]: r["n_rows"] for r in audit.anomaly_counts(df).collect()}
    assert counts["zero_duration"] == 1 and counts["negative_duration"] == 2
    assert counts["zero_distance"] == 2 and counts["negative_distance"] == 1
    assert counts["zero_distance_negative_total"] == 1 and counts["suspicious_zero_distance"] == 1
    assert counts["zero_passengers"] == 1 and counts["negative_total_amount"] == 1 and counts["cash_with_tip"] == 1
    assert audit.suspicious_trips(df).count() == 1
    # A missing component other than the two late fees counts.
    assert audit.mismatch_count(df).first()["n_rows"] == 2
    located = audit.location_audit(df).first().asDict()
    assert (located["total_rows"], located["valid_rows"], located["failed_rows"], located["unknown_zone_rows"]) == (7, 4, 3, 2)
    assert (located["pickup_only"], located["dropoff_only"], located["both_sides"]) == (1, 0, 1)
    outside = audit.out_of_period(df, F.lit("2026-04-01").cast("timestamp"), F.lit("2026-05-31 23:59:59").cast("timestamp"))
    assert [tuple(r) for r in outside.collect()] == [("2026-06", 1)]
    zones = spark.createDataFrame([(1, "EWR"), (265, None)], "LocationID bigint, Borough string")
    unmatched = {r["location_id"]: r["n_rows"] for r in audit.audit_unmatched(df, zones).collect()}
    assert unmatched == {265: 1, 264: 1, None: 1}
    bounds = {r["column"]: (r["minimum"], r["maximum"]) for r in audit.location_bounds(df).collect()}
    assert bounds["PULocationID"] == (1, 265)
