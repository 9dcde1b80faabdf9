"""Exact percentiles with linear interpolation, for columns of any size, by distributed rank selection.

Equal values of a column fold into one row with a count. The folded values of all columns are range-partitioned by
column and value and stored; a range's first rank follows from the totals of the ranges before it. Each wanted rank
then lies in one known range, and only these ranges are read again and counted through. One way for every size: no
task holds more than a range, and only totals, one for each column and range, are put in order as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import materialize


def fold_values(df: DataFrame, columns: Mapping[str, Column], ranges: int | None = None) -> DataFrame:
    """Stored rows ``(name, v, n, part)``: distinct values as doubles with their counts, by range.

    NULL and NaN are left out; the two zeros are one value. ``df`` is read once, whatever is taken from the result.
    """
    plain = df.select(*[c.cast("double").alias(n) for n, c in columns.items()])
    values = plain.select(*[F.when(~F.isnan(n), F.col(n) + F.lit(0.0)).alias(n) for n in columns])
    tall = values.unpivot([], list(columns), "name", "v").filter("v is not null")
    folded = tall.groupBy("name", "v").agg(F.count(F.lit(1)).alias("n"))
    ranged = folded.repartitionByRange(*([ranges] if ranges else []), "name", "v")
    # Stored, since a second evaluation could sample other range bounds.
    return materialize(ranged.withColumn("part", F.spark_partition_id()), "folded-values")


def select_percentiles(folded: DataFrame, names: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Rows ``(name, quantile, value)`` from folded values; a column without values gives NULL."""
    parts = folded.groupBy("name", "part").agg(F.sum("n").alias("part_n"))
    column = Window.partitionBy("name")
    earlier = column.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = parts.withColumns({"start": F.coalesce(F.sum("part_n").over(earlier), F.lit(0)), "size": F.sum("part_n").over(column)})
    each = F.array(*[F.lit(float(q)) for q in dict.fromkeys(quantiles)])
    wanted = spans.select("*", F.explode(each).alias("quantile")).withColumn("position", F.col("quantile") * (F.col("size") - 1))
    sides = F.array(*[F.struct(F.lit(side).alias("side"), rank("position").cast("bigint").alias("rank")) for side, rank in (("lo", F.floor), ("hi", F.ceil))])
    ranks = wanted.select("name", "part", "start", "part_n", "quantile", "position", F.inline(sides))
    # One row for each column, quantile and side.
    ranks = ranks.filter("rank >= start and rank < start + part_n").drop("part_n")
    ranks = materialize(ranks, "percentile-ranks")

    hit = folded.join(F.broadcast(ranks.select("name", "part", "start").distinct()), ["name", "part"])
    within = Window.partitionBy("name", "part").orderBy("v")
    counted = hit.withColumn("upto", F.col("start") + F.sum("n").over(within)).drop("start")
    sought = ranks.select(F.col("name").alias("of"), F.col("part").alias("in_part"), "quantile", "position", "side", "rank")
    match = (F.col("name") == F.col("of")) & (F.col("part") == F.col("in_part"))
    match = match & (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    picked = counted.join(F.broadcast(sought), match).select("name", "quantile", "position", "side", "v")
    found = picked.groupBy("name", "quantile").agg(
        *[F.max(F.when(F.col("side") == side, F.col("v"))).alias(side) for side in ("lo", "hi")], F.max("position").alias("position")
    )
    weight = F.col("position") - F.floor("position")
    step = F.when(F.col("hi") != F.col("lo"), (F.col("hi") - F.col("lo")) * weight).otherwise(0.0)
    found = found.select("name", "quantile", (F.col("lo") + step).alias("value"))
    asked = folded.sparkSession.createDataFrame([(n, float(q)) for n in names for q in quantiles], "name string, quantile double")
    # One row for each column and quantile on both sides.
    return asked.join(F.broadcast(found), ["name", "quantile"], "left")


def exact_percentiles(df: DataFrame, columns: Mapping[str, Column], quantiles: Sequence[float], ranges: int | None = None) -> DataFrame:
    """Rows ``(name, quantile, value)``; NULL and NaN are ignored, a column without values gives NULL."""
    return select_percentiles(fold_values(df, columns, ranges), list(columns), quantiles)


def summarize_values(folded: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column: ``count``, ``mean``, ``std`` (of a sample), ``min`` and ``max`` of its folded values."""
    n, v = F.col("n"), F.col("v")
    first = folded.groupBy("name").agg(F.sum("n").alias("count"), (F.sum(v * n) / F.sum("n")).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
    # One row per column; the deviations are taken from the mean, which is known by now.
    spread = folded.join(F.broadcast(first.select("name", "mean")), "name").groupBy("name").agg(F.sum(n * (v - F.col("mean")) ** 2).alias("squares"))
    found = first.join(F.broadcast(spread), "name").withColumn("std", F.sqrt(F.try_divide("squares", F.col("count") - 1))).drop("squares")
    asked = folded.sparkSession.createDataFrame([(name,) for name in names], "column string")
    joined = asked.join(F.broadcast(found), asked["column"] == found["name"], "left").drop("name")
    return joined.withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
