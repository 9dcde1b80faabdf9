"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import materialize

# Copies of one row are handed out in blocks of this size.
COPY_BLOCK = 100_000


def _order(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def number_by_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Row numbers within groups that may be too large for one task.

    Equal rows are first folded into one row with a count. The distinct rows are range-partitioned
    by group and order, so that a large group spans many partitions; each partition counts within
    itself and starts from the total of the earlier partitions of the group. Counts then unfold
    into rows again, in blocks, spread over the cluster.
    """
    columns = df.columns
    folded = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    rest = [c for c in columns if c not in group and c not in order]
    ranged = folded.repartitionByRange(*[F.col(c) for c in group], *_order([*order, *rest]))
    # Stored, since a second evaluation could sample other range bounds.
    stored = materialize(ranged.withColumn("_part", F.spark_partition_id()), "numbering")

    parts = stored.groupBy(*group, "_part").agg(F.sum("_n").alias("_part_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_part_n").over(earlier), F.lit(0)).alias("_start"),
    )
    match = F.col("_part") == F.col("_p")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    before = (
        Window.partitionBy(*group, "_part")
        .orderBy(*_order([*order, *rest]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = stored.join(starts, match).withColumn(
        "_first", F.col("_start") + F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1
    )
    blocks = placed.select(
        *columns,
        F.col("_first"),
        F.col("_n"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COPY_BLOCK))).alias("_block"),
    ).repartition("_first", "_block")
    low = F.col("_block") * COPY_BLOCK
    high = F.least(low + COPY_BLOCK, F.col("_n")) - 1
    return blocks.select(*columns, F.explode(F.sequence(F.col("_first") + low, F.col("_first") + high)).alias(out))
