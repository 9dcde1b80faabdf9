"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.session import materialize


def held_out(folds: int, fold: int) -> Column:
    """Whether a document must not be learnt from: crc32 of its id as text modulo ``folds`` is ``fold``."""
    return F.crc32(F.col("doc_id").cast("string")) % folds == fold


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``text`` and ``label`` of at most ``per_class`` documents of either class, and the size of each class among all that may be learnt from.

    The rows are those with the smallest hashes of their ids, so the draw does not depend on partitions. Held-out
    rows are left out before the draw; null labels, and labels without a document, count for nothing.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("label in (0, 1)").filter(~held_out(folds, fold))
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    draw = F.xxhash64("doc_id", F.lit(f"{label} sample"))
    parts = [usable.filter(F.col("label") == c).orderBy(draw, "doc_id").limit(per_class) for c in (0, 1)]
    chosen = materialize(parts[0].unionByName(parts[1]).groupBy("doc_id").agg(F.max("label").alias("label")), f"{label}-chosen")
    # At most 2 * per_class ids and labels: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return materialize(rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label"), f"{label}-sample"), sizes
