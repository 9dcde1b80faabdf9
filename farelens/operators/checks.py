"""Declarative table checks: each yields its violations; a suite yields one row per check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.session import broadcast_if_bounded


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their count; keys with a NULL part are ignored."""
    return (
        df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def check_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values that the parent lacks, with their number of child rows; NULL passes.

    The child is counted per value before the join, so a frequent value is one row there.
    """
    counts = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    keys = broadcast_if_bounded(parent.select(F.col(parent_column).alias("_key")))
    return counts.join(keys, F.col("value") == F.col("_key"), "left_anti")


@dataclass(frozen=True)
class Check:
    """One check of a suite. ``kind``: not_null, unique, accepted_values or relationship."""

    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple = ()
    parent: DataFrame | None = field(default=None, compare=False)
    parent_column: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}({', '.join(self.columns)})"


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", (column,), severity)


def unique(*columns: str, severity: str = "error") -> Check:
    return Check("unique", columns, severity)


def accepted_values(column: str, values: Iterable, severity: str = "error") -> Check:
    return Check("accepted_values", (column,), severity, tuple(values))


def relationship(column: str, parent: DataFrame, parent_column: str, severity: str = "error") -> Check:
    return Check("relationship", (column,), severity, parent=parent, parent_column=parent_column)


def run_checks(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """One row per check: name, severity, number of violations, status.

    All row checks share one pass over the table; each unique or relationship check is one aggregation.
    A failed check has the status ``fail``, or ``warn`` where that is its severity.
    """
    counters = {}
    parts = []
    for check in suite:
        c = F.col(check.columns[0])
        if check.kind == "not_null":
            counters[check.name] = (check, F.count_if(c.isNull()))
        elif check.kind == "accepted_values":
            counters[check.name] = (check, F.count_if(c.isNotNull() & ~c.isin(list(check.values))))
        elif check.kind == "unique":
            parts.append((check, check_unique(df, *check.columns).agg(F.count(F.lit(1)).alias("violations"))))
        elif check.kind == "relationship":
            bad = check_relationship(df, check.columns[0], check.parent, check.parent_column)
            parts.append((check, bad.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))))
        else:
            raise ValueError(f"unknown check {check.kind!r}")

    frames = [
        part.select(F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"), "violations")
        for check, part in parts
    ]
    if counters:
        wide = df.agg(*[expr.alias(f"c{i}") for i, (_, expr) in enumerate(counters.values())])
        rows = [
            F.struct(F.lit(n).alias("check"), F.lit(check.severity).alias("severity"), F.col(f"c{i}").alias("violations"))
            for i, (n, (check, _)) in enumerate(counters.items())
        ]
        frames.append(wide.select(F.inline(F.array(*rows))))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    failed = F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    return result.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise(failed))


class CheckFailed(Exception):
    """A check of severity ``error`` found violations."""


def gate(results: DataFrame) -> list:
    """Run the checks (one row each) and stop the caller if one failed; returns the rows."""
    rows = results.collect()
    failed = [f"{r['check']}: {r['violations']}" for r in rows if r["status"] == "fail"]
    if failed:
        raise CheckFailed("; ".join(failed))
    return rows
