"""The corpus pipeline: from raw documents to packed sequences, each stage one operator over all the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelens.llm import line_runs, ngram_join, packing, phrase_index, quality
from farelens.session import fresh_path

STAGES = [
    ("quality classifier", quality.keep_good),
    ("line dedup", line_runs.drop_lines),
    ("n-gram Jaccard join", ngram_join.keep_one),
    ("benchmark decontamination", phrase_index.keep_clean),
    ("best-fit packing", packing.pack),
]

#: The first and the last stage are a trained model and a heuristic on token ids: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
