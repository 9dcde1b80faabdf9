"""What a query reads again is stored."""

import pytest

from farelens.operators import profile
from farelens.operators.staging import stage_trips
from farelens.plans import catalog
from farelens.sources.schemas import RAW_TRIP
from tests.rows import trips


def _raw(spark, tmp_path):
    bad = {"fare_amount": -1.0}
    path = str(tmp_path / "raw")
    trips(spark, {}, bad, bad, {"fare_amount": -2.0, "VendorID": 1}).write.parquet(path)
    return spark.read.schema(RAW_TRIP).parquet(path)


def test_quarantine_reads_stored_rows(spark, tmp_path, monkeypatch):
    raw = _raw(spark, tmp_path)
    monkeypatch.setattr(catalog, "staged_trips", lambda *_: stage_trips(raw))
    found = catalog._quarantined(spark, "")
    assert not set(found.inputFiles()) & set(raw.inputFiles())
    assert sorted(r["dup_seq"] for r in found.collect()) == [1, 1, 2, 3]


@pytest.mark.parametrize("name", ["profile_rows", "profile_document"])
def test_profiles_read_stored_rows(spark, tmp_path, monkeypatch, name):
    raw, seen = _raw(spark, tmp_path), []
    monkeypatch.setattr(catalog, "raw_trips", lambda *_: raw)
    rows = profile.hour_distribution(raw).selectExpr("'s' as section", "'' as name", "cast(hour as string) as key", "probability as value")
    monkeypatch.setattr(profile, "profile_rows", lambda df, key: seen.append(df) or rows)
    catalog.queries()[name](spark, "")
    assert seen[0].count() == 4 and not set(seen[0].inputFiles()) & set(raw.inputFiles())
