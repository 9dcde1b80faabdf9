"""Quality scorecard, quarantine reasons and source freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.operators.rules import RULE_NAMES

# Freshness limits in minutes.
WARN_MINUTES = 15
ERROR_MINUTES = 60


def dq_scorecard(
    flagged: DataFrame,
    period: str | None = None,
    rule_names: Sequence[str] = RULE_NAMES,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per period and rule: total and failed rows and their ratio at four places.

    All rules are counted in one aggregation. A NULL flag is not counted as failed. With a
    ``period`` there is one row per rule even without trips; without one, each period found gets rows.
    """
    counts = [F.count(F.lit(1)).alias("total_rows"), *[F.count_if(~F.col(n)).alias(n) for n in rule_names]]
    if period is None:
        wide = flagged.groupBy(F.col("source_period").alias("reporting_period")).agg(*counts)
    else:
        wide = flagged.agg(*counts).withColumn("reporting_period", F.lit(period))
    tall = wide.unpivot(["reporting_period", "total_rows"], list(rule_names), "rule_name", "failed_rows")
    return tall.select(
        "reporting_period",
        "rule_name",
        "total_rows",
        "failed_rows",
        F.round(F.try_divide("failed_rows", "total_rows"), 4).alias("failed_pct"),
        (F.current_timestamp() if as_of is None else as_of).alias("run_at"),
    )


def quarantine_reasons(quarantined: DataFrame) -> DataFrame:
    """How often each reason occurs; a row with several reasons counts for each."""
    combos = quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n"))
    return (
        combos.select(F.explode(F.split("quarantine_reason", ", ")).alias("reason"), "n")
        .groupBy("reason")
        .agg(F.sum("n").alias("n_rows"))
    )


def freshness(
    df: DataFrame,
    ts_col: str = "ingestion_time",
    now: Column | None = None,
    warn_minutes: int = WARN_MINUTES,
    error_minutes: int = ERROR_MINUTES,
) -> DataFrame:
    """Age of the newest row and its status. An empty source is an error."""
    now = F.current_timestamp() if now is None else now
    newest = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("newest"))
    age = (F.unix_micros(now) - F.unix_micros("newest")) / F.lit(60_000_000.0)
    return newest.select("newest", age.alias("age_minutes")).withColumn(
        "status",
        F.when(F.col("age_minutes") > error_minutes, "error")
        .when(F.col("age_minutes") > warn_minutes, "warn")
        .when(F.col("age_minutes").isNotNull(), "pass")
        .otherwise("error"),
    )
