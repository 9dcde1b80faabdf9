"""Every registered query against its SQL in another engine, on the given tables."""

import os

import pytest

from farelens.plans import catalog, oracle
from tests.compare import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
SQL = oracle.statements()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR) is None


def test_profile_rows(spark):
    sections = {r["section"]: r["count"] for r in QUERIES["profile_rows"](spark, SF_DIR).groupBy("section").count().collect()}
    assert sections["hour_distribution"] == 24 and sections["fare_per_mile"] == 3
    assert set(sections) == {
        "hour_distribution", "trip_distance_values", "fare_per_mile", "tip_per_fare", "speed_distribution", "category_distribution"
    }


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
