"""Quality classifier: supervised subword embeddings.

Every word and every run of three or four bytes inside a word is hashed to one of a fixed number of vectors; a word
that repeats the one before it has a vector for that besides. A document is the mean of the vectors of all its features; a softmax layer over two classes turns it into a
probability. Vectors and layer are learnt together by stochastic gradient descent on a bounded sample of labelled
rows. Since the layer is linear, a trained model scores a text as the mean of one number for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm.labelled import held_out, training_sample
from farelens.llm.words import NOT_SPACE, Block, small_batches, text_blocks
from farelens.session import spread

#: Labelled rows of either class to learn from, and of these the share kept back to set the scale of the output.
PER_CLASS = 1_500
CALIBRATION_SHARE = 0.3
BUCKET_BITS = 18
GRAMS = (3, 4)
#: The bucket of "same word once more".
REPEAT = 1
DIMENSIONS = 8
EPOCHS = 6
RATE = 0.1
THRESHOLD = 0.7


@dataclass
class Model:
    """``weights`` of the features and ``bias`` give log odds, ``slope`` and ``shift`` set their scale."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, log_odds: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (log_odds + self.bias) + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def features(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and rows of words, of words that repeat the one before, then of the byte runs of each length."""
    shift = np.uint64(64 - BUCKET_BITS)
    row = np.repeat(np.arange(block.n_rows), np.diff(block.bounds))
    words = block.hashes()
    yield (words >> shift).astype(np.int32), row
    again = np.flatnonzero((words[1:] == words[:-1]) & (row[1:] == row[:-1])) + 1
    yield np.full(len(again), REPEAT, np.int32), row[again]
    sizes = block.ends - block.starts
    for n in GRAMS:
        long = np.flatnonzero(sizes >= n)
        counts = sizes[long] - n + 1
        first = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) - np.repeat(first - block.starts[long], counts)
        yield (block.span_hashes(at, at + n) >> shift).astype(np.int32), np.repeat(row[long], counts)


def mean_weights(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The mean weight of the features of each text; 0 without features."""
    out = np.zeros(len(texts))
    for block in text_blocks(texts, NOT_SPACE, lower=False):
        total, n = np.zeros(block.n_rows), np.zeros(block.n_rows)
        for buckets, row in features(block):
            total += np.bincount(row, weights[buckets], block.n_rows)
            n += np.bincount(row, minlength=block.n_rows)
        out[block.first_row : block.first_row + block.n_rows] = total / np.maximum(n, 1)
    return out


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct features of each text and their shares."""
    out = []
    for block in text_blocks(pa.array(texts, pa.string()), NOT_SPACE, lower=False):
        parts = list(features(block))
        buckets, row = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, counts = np.unique(row.astype(np.int64) << 32 | buckets, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(block.n_rows + 1, dtype=np.int64) << 32)
        for a, b in zip(cuts, cuts[1:], strict=False):
            out.append(((keys[a:b] & 0xFFFFFFFF).astype(np.int32), (counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32)))
    return out


def train(texts: list[str], labels: np.ndarray, sizes: dict[int, int], seed: int = 7) -> Model:
    """Learn from the texts, whatever their number; ``sizes`` are the classes' sizes among all labelled rows.

    Without rows of both classes, every score is the share of class 1 among the labels, or 0.5 without any.
    """
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    prior = np.log((n1 + 0.5) / (n0 + 0.5))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 0.0, float(prior))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    kept_back = max(2, int(CALIBRATION_SHARE * len(texts)))
    learn, tune = (order[kept_back:], order[:kept_back]) if len(texts) >= 40 else (order, order)
    bags = _bags(texts)
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = rng.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(learn), 0
    share = np.array([np.mean(labels[learn] != 0), np.mean(labels[learn] != 1)]) + 1e-6  # the smaller class weighs more
    for _ in range(EPOCHS):
        for k in rng.permutation(learn):
            rate = RATE * (1 - done / steps)
            done += 1
            buckets, parts = bags[k]
            if not len(buckets):
                continue
            mean = parts @ vectors[buckets]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            p *= 2 * share[labels[k]]
            back = layer @ p
            layer -= (0.1 * rate * np.outer(mean, p)).astype(np.float32)
            bias -= (0.1 * rate * p).astype(np.float32)
            # Each vector moves with its share; the sum of squares makes long texts teach as much as short ones.
            vectors[buckets] -= np.outer(parts / (parts @ parts), rate * back).astype(np.float32)
    weights = (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
    bias = float(bias[1] - bias[0])
    odds = np.array([float(bags[k][1] @ weights[bags[k][0]]) for k in tune]) + bias
    slope, shift = _scale(odds, labels[tune])
    sampled = np.log((np.sum(labels == 1) + 0.5) / (np.sum(labels == 0) + 0.5))
    return Model(weights, bias, slope, shift + float(prior - sampled))


def _scale(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and shift of the logistic curve through rows the vectors were not learnt from."""
    spread_ = odds.std() or 1.0
    x, y = odds / spread_, labels.astype(float)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(a * x + b)
        w = p * (1 - p) + 1e-6
        g = np.array([np.sum((p - target) * x), np.sum(p - target)])
        h = np.array([[np.sum(w * x * x) + 1e-3, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(a / spread_)), float(b)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, per_class: int = PER_CLASS) -> Model:
    """The model for ``labels.quality``, learnt from at most ``per_class`` rows of either class that are not held out."""
    sample, sizes = training_sample(docs, labels, "quality", folds, fold, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t, y) for batch in batches for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)]
        model = train([t for t, _ in rows], np.array([y for _, y in rows], np.int64), sizes)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias], "slope": [model.slope], "shift": [model.shift]})

    # One task learns from the bounded sample; the texts do not come to the driver.
    one = sample.select("doc_id", "text", "label").repartition(1).sortWithinPartitions("doc_id", "text")
    learnt = one.mapInArrow(run, "weights binary, bias double, slope double, shift double").first()
    if learnt is None:  # no labelled text, no task
        return train([], np.zeros(0, np.int64), sizes)
    weights, bias, slope, shift = learnt
    return Model(np.frombuffer(weights, np.float32), bias, slope, shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` of every row of ``docs``; whole texts are read, nulls and empty texts score as the bias says."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a fixed number of buckets: 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.scores(mean_weights(batch.column("text"), shared.value.weights))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], ["doc_id", "score"])

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return spread(docs, docs).mapInArrow(run, "doc_id bigint, score double")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted to be of good quality stay; all columns stay."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    shared = spark.sparkContext.broadcast(model)
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.scores(mean_weights(batch.column("text"), shared.value.weights))
            yield batch.filter(pa.array(values >= THRESHOLD))

    # One pass: the rows that stay leave the task that scored them.
    return spread(docs, docs).mapInArrow(run, docs.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_quality": op8_quality}
SQL: dict[str, str] = {}
