import pytest

from farelens.operators import checks


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "a")], "k int, v string")


def test_single_checks(spark, child):
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    assert checks.check_not_null(child, "v").count() == 1
    assert [tuple(r) for r in checks.check_unique(child, "k").collect()] == [(1, 2)]
    assert checks.check_unique(child, "k", "v").count() == 0
    assert [r["v"] for r in checks.check_accepted_values(child, "v", ["a", "b"]).collect()] == ["z"]
    assert [tuple(r) for r in checks.check_relationship(child, "k", parent, "id").collect()] == [(2, 1)]


def test_suite_and_gate(spark, child):
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    suite = [
        checks.not_null("v", severity="warn"),
        checks.not_null("k"),
        checks.accepted_values("v", ["a", "b", "z"]),
        checks.unique("k"),
        checks.relationship("k", parent, "id"),
    ]
    rows = {r["check"]: (r["violations"], r["status"]) for r in checks.run_checks(child, suite).collect()}
    assert rows == {
        "not_null(v)": (1, "warn"),
        "not_null(k)": (2, "fail"),
        "accepted_values(v)": (0, "pass"),
        "unique(k)": (1, "fail"),
        "relationship(k)": (1, "fail"),
    }
    with pytest.raises(checks.CheckFailed, match="not_null"):
        checks.gate(checks.run_checks(child, suite))
    assert len(checks.gate(checks.run_checks(child, suite[:1]))) == 1


def test_row_checks_share_one_scan(child):
    suite = [checks.not_null("v"), checks.not_null("k"), checks.accepted_values("v", ["a"])]
    plan = checks.run_checks(child, suite)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
