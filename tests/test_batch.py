from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelens.operators.checks import CheckFailed
from farelens.plans.batch import Warehouse, comparison_suite, read_raw, refresh_comparison, run_period
from farelens.operators import checks
from farelens.sources import versions
from tests.rows import trips

ZONES = "LocationID,Borough,Zone,service_zone\n" + "".join(f"{i},B{i % 3},Z{i},s\n" for i in (1, 2, 12, 264, 265))


def at(day, hour, month=4):
    return {
        "lpep_pickup_datetime": datetime(2026, month, day, hour),
        "lpep_dropoff_datetime": datetime(2026, month, day, hour, 20),
    }


APRIL = [{}, at(1, 0), at(2, 21), {**at(3, 9), "passenger_count": 0}, {**at(4, 9), "trip_distance": None}, at(5, 5), at(5, 5), at(30, 23, 3)]
MAY = [at(1, 7, 5), {**at(2, 7, 5), "DOLocationID": 265}]


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(ZONES)
    trips(spark, *APRIL).write.parquet(str(tmp_path / "april"))
    trips(spark, *MAY).write.parquet(str(tmp_path / "may"))
    return tmp_path


def stored(spark, root, name):
    """A table of the warehouse; those with versions are read as their newest manifest has them."""
    path = f"{root}/wh/{name}"
    if not versions.is_versioned(spark, path):
        return spark.read.parquet(path)
    _, manifest = versions.read_manifest(spark, path)
    return spark.read.option("basePath", path).parquet(*[f"{path}/version={v}/{f}" for f, v in manifest.items()]).drop("version")


def tables(spark, root):
    def rows(name):
        df = stored(spark, root, name)
        hidden = [c for c in ("_loaded_at", "run_at", "dq_checked_at", "marts_last_refreshed_at") if c in df.columns]
        return sorted(str(tuple(r)) for r in df.drop(*hidden).collect())

    names = "int_trips_enriched int_quarantine_trips dq_check_result daily_trips_summary hourly_demand_summary payment_behavior_summary route_performance_summary zone_performance_summary"
    return {n: rows(n) for n in names.split()}


def run(spark, root, period, file, **options):
    return run_period(spark, period, [str(root / file)], str(root / "zones.csv"), Warehouse(f"{root}/wh"), **options)


def test_two_periods_and_a_repeated_run(spark, place):
    april = run(spark, place, "2026-04", "april")
    assert (april["clean"], april["quarantined"], april["unrouted"]) == (3, 3, 1)
    may = run(spark, place, "2026-05", "may")
    assert (may["clean"], may["quarantined"], may["unrouted"]) == (1, 1, 0)
    first = tables(spark, place)
    assert [len(first[n]) for n in ("int_trips_enriched", "int_quarantine_trips", "dq_check_result")] == [4, 4, 10]
    run(spark, place, "2026-04", "april")
    assert tables(spark, place) == first
    # The row of another month stays once, however often its file is loaded.
    assert read_raw(spark, Warehouse(f"{place}/wh")).filter("source_period = '2026-03'").count() == 1


def test_marts_of_one_period_at_a_time_equal_a_full_rebuild(spark, place):
    from farelens.plans.batch import refresh_marts
    from farelens.sources.tables import read_table

    run(spark, place, "2026-04", "april")
    run(spark, place, "2026-05", "may")
    trips(spark, *APRIL[:3]).write.parquet(str(place / "fewer"))
    run(spark, place, "2026-04", "fewer")
    period_by_period = tables(spark, place)
    warehouse = Warehouse(f"{place}/wh")
    _, before = versions.read_manifest(spark, warehouse.path("partials_daily"))
    assert sorted(before) == ["source_period=2026-04", "source_period=2026-05"]
    enriched = stored(spark, place, "int_trips_enriched")
    refresh_marts(enriched, warehouse)
    assert tables(spark, place) == period_by_period
    schemas = stored(spark, place, "raw_taxi_trip_schemas")
    assert sorted(str(r["load_period"]) for r in schemas.collect()) == ["2026-04", "2026-05"]


def test_a_failed_check_stops_the_run(spark, place):
    bad = trips(spark, {}, {**at(2, 2), "trip_type": 3})
    bad.write.parquet(str(place / "bad"))
    with pytest.raises(CheckFailed, match="trip_type"):
        run(spark, place, "2026-04", "bad")
    outcome = run(spark, place, "2026-04", "bad", stop_on_failure=False)
    assert outcome["clean"] == 2
    failed = [r["check"] for r in outcome["checks"]["staging"] if r["status"] == "fail"]
    assert failed == ["accepted_values(trip_type)"]


def test_strict_policy_quarantines_what_sql_leaves_out(spark, place):
    outcome = run(spark, place, "2026-04", "april", null_policy="strict")
    assert (outcome["clean"], outcome["quarantined"], outcome["unrouted"]) == (3, 4, 0)


def test_comparison_of_batch_and_stream(spark, place):
    run(spark, place, "2026-04", "april")
    enriched = stored(spark, place, "int_trips_enriched")
    refresh_comparison(enriched, enriched.select(*[F.col(c) for c in ("trip_distance", "fare_amount", "total_amount")]), Warehouse(f"{place}/wh"))
    mart = spark.read.parquet(f"{place}/wh/batch_streaming_comparison")
    assert {r["data_source"]: r["trip_count"] for r in mart.collect()} == {"batch": 3, "streaming": 3}
    assert len(checks.gate(checks.run_checks(mart, comparison_suite()))) == 7


def test_period_filter_reaches_the_files(spark, place, capsys):
    from farelens.operators.staging import for_period, stage_trips
    from farelens.plans.batch import load_raw

    warehouse = Warehouse(f"{place}/wh")
    load_raw(spark, warehouse, "2026-04", str(place / "april"))
    staged = for_period(stage_trips(read_raw(spark, warehouse)), "2026-04").select("fare_amount")
    staged.explain("formatted")
    plan = capsys.readouterr().out
    partition_filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "source_period" in partition_filters
    assert "GreaterThanOrEqual(lpep_pickup_datetime" in plan and "LessThan(lpep_pickup_datetime" in plan
    assert "ReadSchema: struct<lpep_pickup_datetime:timestamp,fare_amount:double>" in plan
    assert staged.count() == 7


def test_flagging_does_not_shuffle_wide_rows(spark, place):
    from farelens.operators import rules
    from farelens.operators.staging import stage_trips
    from farelens.sources.readers import read_trips

    flagged = rules.flag_trips(stage_trips(read_trips(spark, str(place / "april"))))
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan
