import pytest
from pyspark.sql import functions as F

from farelens.operators import marts
from farelens.operators.enrich import enrich_trips
from farelens.operators.scorecard import dq_scorecard, quarantine_reasons
from farelens.operators.staging import stage_trips
from farelens.operators import rules
from tests.rows import trips


@pytest.fixture(scope="module")
def enriched(spark):
    from datetime import datetime

    changes = [
        {},
        {"tip_amount": None, "payment_type": 5, "DOLocationID": 7},
        {"fare_amount": 0.0, "payment_type": 3, "lpep_pickup_datetime": datetime(2026, 4, 11, 21, 0)},
        {"PULocationID": None, "DOLocationID": 1},
        {"PULocationID": 99, "trip_distance": None},
    ]
    zones = spark.createDataFrame(
        [(1, "B1", "Z1", "s"), (12, "B2", "Z12", "s"), (7, "B3", "Z7", "s")],
        "location_id bigint, borough string, zone string, service_zone string",
    )
    staged = stage_trips(trips(spark, *changes))
    return enrich_trips(staged.withColumn("trip_id", F.lit("k")), zones).persist()


def test_enriched_rows(enriched):
    rows = {(r["pu_location_id"], r["do_location_id"]): r for r in enriched.collect()}
    assert (rows[99, 12]["pickup_zone"], rows[99, 12]["dropoff_zone"]) == (None, "Z12")
    assert rows[None, 1]["pickup_zone"] is None and rows[None, 1]["dropoff_borough"] == "B1"
    assert len(enriched.columns) == 36 - 1 + 1


@pytest.mark.parametrize("name", list(marts.MARTS))
def test_marts_from_shared_partials_equal_marts_from_trips(enriched, name):
    as_of = F.lit(0)
    build = marts.MARTS[name]
    direct, shared = build(enriched, as_of), build(marts.rollup_trips(enriched), as_of)

    def rows(df):
        return sorted([[f"{v:.9f}" if isinstance(v, float) else str(v) for v in r] for r in df.collect()])

    assert direct.columns == shared.columns
    assert rows(direct) == rows(shared)


def test_payment_mart(enriched):
    rows = {r["payment_type"]: r for r in marts.payment_behavior_summary(enriched).collect()}
    assert rows[5]["payment_label"] == "Unknown"
    assert rows[5]["avg_tip_amount"] is None and rows[5]["tip_rate"] is None
    assert rows[3]["tip_rate"] is None  # a zero divisor
    assert rows[1]["total_trips"] == 3 and rows[1]["tip_rate"] == pytest.approx(0.2)


def test_zone_mart(enriched):
    rows = {r["location_id"]: r for r in marts.zone_performance_summary(enriched).collect()}
    assert set(rows) == {1, 12, 7, 99, None}
    assert (rows[1]["total_pickup_trips"], rows[1]["total_dropoff_trips"], rows[1]["zone"]) == (3, 1, "Z1")
    assert (rows[7]["total_pickup_trips"], rows[7]["total_revenue"], rows[7]["avg_fare_amount"]) == (0, 0.0, None)
    assert rows[99]["zone"] is None and rows[99]["avg_trip_distance"] is None
    # A missing location has a row, but no trips match it.
    assert (rows[None]["total_pickup_trips"], rows[None]["total_dropoff_trips"], rows[None]["zone"]) == (0, 0, None)


def test_zone_mart_equals_its_definition_by_joins(enriched):
    p = enriched.groupBy(F.col("pu_location_id").alias("location_id")).agg(F.count("*").alias("p"), F.sum("total_amount").alias("r"))
    d = enriched.groupBy(F.col("do_location_id").alias("location_id")).agg(F.count("*").alias("d"))
    ids = p.select("location_id").union(d.select("location_id")).distinct()
    want = ids.join(p, "location_id", "left").join(d, "location_id", "left").fillna(0, ["p", "d", "r"])
    got = marts.zone_performance_summary(enriched).select(
        "location_id", F.col("total_pickup_trips").alias("p"), F.col("total_revenue").alias("r"), F.col("total_dropoff_trips").alias("d")
    )
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_route_mart_keeps_one_row_per_route_when_names_change(spark, enriched):
    renamed = enriched.withColumn("pickup_zone", F.when(F.col("trip_distance").isNull(), None).otherwise(F.col("pickup_zone")))
    twice = enriched.unionByName(renamed)
    rows = marts.route_performance_summary(twice).collect()
    assert len(rows) == len({(r["pickup_location_id"], r["dropoff_location_id"]) for r in rows})
    assert sum(r["total_trips"] for r in rows) == 10


def test_scorecard(spark):
    flagged = rules.apply_rules(stage_trips(trips(spark, {}, {"trip_distance": None}, {"trip_distance": -1.0})))
    rows = {r["rule_name"]: r for r in dq_scorecard(flagged, "2026-04").collect()}
    assert list(rows) == list(rules.RULE_NAMES)
    row = rows["is_valid_distance"]
    assert (row["reporting_period"], row["total_rows"], row["failed_rows"], row["failed_pct"]) == ("2026-04", 3, 1, 0.3333)


def test_scorecard_without_trips(spark):
    flagged = rules.apply_rules(stage_trips(trips(spark, {}).filter("false")))
    rows = dq_scorecard(flagged, "2026-04").collect()
    assert [(r["total_rows"], r["failed_rows"], r["failed_pct"]) for r in rows] == [(0, 0, None)] * 5
    assert dq_scorecard(flagged).count() == 0


def test_quarantine_reasons(spark):
    df = spark.createDataFrame([("a, b",), ("a",), ("a",)], "quarantine_reason string")
    assert {r["reason"]: r["n_rows"] for r in quarantine_reasons(df).collect()} == {"a": 3, "b": 1}


def test_partials_are_not_stored_at_the_grain_of_all_marts(spark, tmp_path, monkeypatch):
    from datetime import datetime, timedelta

    from farelens.operators.enrich import enrich_trips
    from farelens.operators.staging import stage_trips, stage_zones
    from farelens.plans import batch
    from farelens.sources.schemas import RAW_ZONE
    from tests.rows import trips

    start = datetime(2026, 4, 1)
    changes = [
        {"lpep_pickup_datetime": start + timedelta(hours=h), "lpep_dropoff_datetime": start + timedelta(hours=h, minutes=9), "DOLocationID": z, "payment_type": p}
        for h in range(6) for z in range(5) for p in (1, 2)
    ]
    zones = stage_zones(spark.createDataFrame([(k, "b", f"z{k}", "s") for k in range(6)], RAW_ZONE))
    rows = enrich_trips(stage_trips(trips(spark, *changes)), zones).cache()
    counts, whole = [], batch.materialize
    monkeypatch.setattr(batch, "materialize", lambda df, name: counts.append(df.count()) or whole(df, name))
    warehouse = batch.Warehouse(str(tmp_path / "wh"))
    batch.update_partials(rows, warehouse, "2026-04")
    # 60 trips: 6 hours, and 5 routes of 2 payments.
    assert counts == [6, 10]
    n = {name: batch.read_partials(rows, warehouse, name) for name in marts.PARTIALS}
    assert {k: (v.count(), v.agg({"rows_n": "sum"}).first()[0]) for k, v in n.items()} == {"daily": (1, 60), "hourly": (6, 60), "payment": (2, 60), "route": (5, 60)}
