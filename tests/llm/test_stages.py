"""Queries without SQL against plain ways on the given tables; pipeline stages on odd and empty tables."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from farelens.llm import packing, phrase_index, quality, toxicity

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")


def test_packing_equals_the_tokenizer(spark):
    """Start, length and checksum of every piece, and as few sequences as packing one piece after another needs."""
    got = packing.op2_packing(spark, SMALL).toPandas()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for row in rows:
        ids = np.array([*exact.encode(row["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[row["doc_id"], k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    room = []
    for length in sorted((x[1] for x in want.values()), reverse=True):
        fits = [k for k, left in enumerate(room) if left >= length]
        if fits:
            best = min(fits, key=lambda k: room[k])
            room[best] -= length
        else:
            room.append(1024 - length)
    assert got["sequence_id"].nunique() == len(room)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert (part["offset"].to_numpy() == np.append(0, np.cumsum(part["length"]))[:-1]).all() and part["length"].sum() <= 1024


@pytest.mark.parametrize("query, label, accuracy", [(quality.op8_quality, "quality", 0.97), (toxicity.op1_toxicity, "toxic", 0.97)])
def test_held_out_accuracy_on_the_given_tables(spark, query, label, accuracy):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    scored = query(spark, LARGE).join(labels.filter("label is not null"), "doc_id").filter("held_out")
    right = F.avg((F.col("predicted") == F.col("label")).cast("int"))
    row = scored.agg(right.alias("right"), F.count(F.lit(1)).alias("n")).first()
    assert row["n"] > 500 and row["right"] >= accuracy


def test_decontamination_stage_reads_rows_without_id(spark, tmp_path):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    bad, good = "so one two three four five six seven eight nine ten ends", "nothing of the kind"
    docs = spark.createDataFrame([(1, bad), (2, good), (None, bad), (None, good), (None, good), (None, None)], "doc_id bigint, text string")
    left = phrase_index.keep_clean(spark, docs, str(tmp_path)).collect()
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in left) == sorted(
        [("2", repr(good)), ("None", repr(good)), ("None", repr(good)), ("None", "None")]
    )


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = stage(spark, docs.filter("doc_id < 0"), SMALL)
    assert out.count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
