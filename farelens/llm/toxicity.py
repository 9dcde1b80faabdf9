"""Toxicity by maximum-scoring segments of token log odds.

A token is a word or, as a back-off for words of few texts, the first characters of one. Its weight is the log odds of
toxic against other labelled texts, with a Dirichlet prior of half a text and what its frequency in all documents adds;
the weight counts as far as it is sure (by its lower bound), and tokens without a sure weight pull a segment down. A word
weighs as much as the surer of its two tokens. One scan over a text, linear in its words, finds all its maximal segments of positive weight. Their scores
follow an extreme-value law in clean text, which turns a score and the text's length into an expected number of such
segments by chance; the segments that chance does not explain are the toxic passages. A logistic curve over the
evidence of the passages, which never falls as the evidence grows, gives the probability of the label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm.labelled import held_out, training_sample
from farelens.llm.quality import sigmoid
from farelens.llm.words import ALPHANUMERIC, Block, small_batches, text_blocks
from farelens.session import materialize, spread

#: Labelled rows of either class to learn from.
PER_CLASS = 3_000
#: Tokens of fewer sample texts have no sure weight.
LEAST_COUNT = 3
#: Characters of a word's beginning that are a token of their own.
STEM = 4
#: Weight of the prior, as a number of texts' tokens, besides half a text for each token.
PRIOR_TOKENS = 5_000.0
LEAST_PRIOR = 0.5
#: Standard errors between a weight and its lower bound.
Z = 2.5
#: What a token without evidence adds to a segment.
DRIFT = -1.0
MAX_WEIGHT = 8.0
#: Segments expected at most so often in a clean text of that length are passages.
SIGNIFICANT = 0.05
THRESHOLD = 0.5


@dataclass
class Model:
    """Token hashes (sorted) and weights; ``rate`` and ``log_k`` of the extreme-value law; the logistic curve."""

    tokens: np.ndarray
    weights: np.ndarray
    rate: float
    log_k: float
    curve: np.ndarray

    def token_weights(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        return surer(self._weights(words), self._weights(stems))

    def _weights(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.full(len(hashes), DRIFT)
        at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
        return np.where(self.tokens[at] == hashes, self.weights[at], DRIFT)


def surer(words: np.ndarray, stems: np.ndarray) -> np.ndarray:
    """Weights of words with their beginnings: the larger one, but a word that is surely clean stays so."""
    return np.where(words < DRIFT, words, np.maximum(words, stems))


def maximal_segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, score) of a sequence, in linear time.

    Stretches of one sign act as one token. A candidate is joined with the last earlier one that begins lower, if its
    end lies higher; only ends of the stack are looked at, so each candidate is joined once.
    """
    positive = weights > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[False], positive, [False]]).astype(np.int8)))
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    stack: list[list[float]] = []  # from, to, sum before, sum after, index of the last earlier one that begins lower
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        start, end, low, high = a, b, float(sums[a]), float(sums[b])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = int(stack[j][4])
            if j < 0 or stack[j][3] >= high:
                stack.append([start, end, low, high, j])
                break
            start, low = int(stack[j][0]), stack[j][2]
            del stack[j:]
    return [(int(s), int(e), high - low) for s, e, low, high, _ in stack]


def _evidence(scores: list[float], n: int, rate: float, log_k: float) -> tuple[float, float]:
    """How unlikely the best segment is (minus the log of its expected number), and the sum of significant ones."""
    if not scores:
        return -np.log(max(n, 1)) - log_k, 0.0
    logs = [rate * s - np.log(max(n, 1)) - log_k for s in scores]
    return max(logs), sum(x for x in logs if x > -np.log(SIGNIFICANT))


def _inputs(best: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(best)), np.clip(best, -20, 40) / 10, np.log1p(np.clip(total, 0, None))])


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's words and of their first STEM characters; a shorter word is its own beginning."""
    leads = np.flatnonzero((block.data & 0xC0) != 0x80)  # first bytes of characters
    at = np.searchsorted(leads, block.starts) + STEM
    ends = np.minimum(np.append(leads, np.full(STEM + 1, len(block.data)))[at], block.ends)
    stems = block.span_hashes(block.starts, ends) ^ np.uint64(0x5DEECE66D)
    return block.hashes().view(np.int64), stems.view(np.int64)


def _texts(batch: pa.RecordBatch):
    for block in text_blocks(batch.column("text"), ALPHANUMERIC):
        words, stems = _tokens(block)
        for r in range(block.n_rows):
            own = slice(block.bounds[r], block.bounds[r + 1])
            yield block.first_row + r, words[own], stems[own], block


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_pylist()
        parts = [[], []]
        for row, words, stems, _ in _texts(batch):
            # A token counts once a text: one that a single text repeats says little about the label.
            parts[labels[row]].append(np.unique(np.concatenate([words, stems])))
        for label in (0, 1):
            if parts[label]:
                tokens, counts = np.unique(np.concatenate(parts[label]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens), pa.array(np.full(len(tokens), label, np.int32)), pa.array(counts.astype(np.int64))],
                    ["token", "label", "n"],
                )


def _corpus_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        counts, total = np.zeros(len(tokens) + 1, np.int64), 0
        for batch in batches:
            for block in text_blocks(batch.column("text"), ALPHANUMERIC):
                hashes = np.concatenate(_tokens(block))
                at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                at = np.where(tokens[at] == hashes, at, len(tokens))
                row = np.tile(np.repeat(np.arange(block.n_rows), np.diff(block.bounds)), 2)
                once = np.unique(row * (len(tokens) + 1) + at)  # once a text, as in the sample
                counts += np.bincount(once % (len(tokens) + 1), minlength=len(counts))
        total = int(counts.sum())
        seen = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(tokens[seen], 0)), pa.array(np.append(counts[seen], total)), pa.array(np.append(np.zeros(len(seen), bool), True))],
            ["token", "n", "is_total"],
        )

    return run


def log_odds(toxic: np.ndarray, clean: np.ndarray, prior: np.ndarray, n_toxic: float, n_clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each token with a Dirichlet prior, and their standard errors."""
    a, b, total = toxic + prior, clean + prior, prior.sum()
    delta = np.log(a / (n_toxic + total - a)) - np.log(b / (n_clean + total - b))
    return delta, np.sqrt(1 / a + 1 / b)


def sure_weights(delta: np.ndarray, error: np.ndarray) -> np.ndarray:
    """The lower bound of log odds above 0, the upper bound of those below it, and the drift for all in between."""
    return np.where(delta > Z * error, np.minimum(delta - Z * error, MAX_WEIGHT), np.where(delta < -Z * error, np.maximum(delta + Z * error, -3.0) + DRIFT, DRIFT))


def extreme_value_rate(weights: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * weight)) = 1; there is one as the mean weight is negative."""
    if not (weights[shares > 0] > 0).any():
        return 1.0
    low, high = 1e-6, 1.0
    value = lambda r: float((shares * np.exp(np.minimum(r * weights, 500))).sum()) - 1
    while value(high) < 0:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def _weights(counts, corpus: dict[int, int], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and weights."""
    tokens = np.sort(counts["token"].unique())
    toxic, clean = (np.zeros(len(tokens)) for _ in range(2))
    for label, into in ((1, toxic), (0, clean)):
        part = counts[counts["label"] == label]
        into[np.searchsorted(tokens, part["token"])] = part["n"]
    share = np.array([corpus.get(int(t), 0) for t in tokens]) / max(total, 1)
    return tokens, sure_weights(*log_odds(toxic, clean, LEAST_PRIOR + PRIOR_TOKENS * share, counts.attrs["n1"], counts.attrs["n0"]))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic curve; all but the first are at least 0 (columns that would get less are left out)."""
    used = np.arange(x.shape[1])
    while True:
        z, w = x[:, used], np.zeros(len(used))
        for _ in range(60):
            p = sigmoid(z @ w)
            h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + 0.1 * np.eye(len(used))
            w = w - np.clip(np.linalg.solve(h, z.T @ (p - y) + 0.1 * w), -2, 2)
        if len(used) == 1 or w[1:].min() >= 0:
            out = np.zeros(x.shape[1])
            out[used] = w
            return out
        used = np.delete(used, 1 + w[1:].argmin())


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, per_class: int = PER_CLASS) -> Model:
    """The model for ``labels.toxic``: labels of at most ``per_class`` rows of either class, corpus counts of all rows.

    Without toxic rows to learn from, no token has a positive weight and all scores are the share of toxic rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    sample, sizes = training_sample(docs, labels, "toxic", folds, fold, per_class)
    counts = sample.mapInArrow(_sample_counts, "token bigint, label int, n bigint").groupBy("token", "label").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "toxic-counts")
    totals = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    often = counts.groupBy("token").agg(F.sum("n").alias("all")).filter(F.col("all") >= LEAST_COUNT)
    # Tokens of at most 2 * per_class texts.
    frame = counts.join(often.select("token"), "token").toPandas()
    frame.attrs.update(n0=float(totals.get(0, 0)), n1=float(totals.get(1, 0)))
    corpus, total = {}, 0
    if len(frame):
        shared = spark.sparkContext.broadcast(np.sort(frame["token"].unique()))
        found = spread(docs, docs).select("text").mapInArrow(_corpus_counts(shared), "token bigint, n bigint, is_total boolean")
        for row in found.groupBy("token", "is_total").agg(F.sum("n").alias("n")).toLocalIterator():  # one row a token of the sample
            if row["is_total"]:
                total = row["n"]
            else:
                corpus[row["token"]] = row["n"]
        shared.destroy()
    tokens, weights = _weights(frame, corpus, total) if len(frame) else (np.zeros(0, np.int64), np.zeros(0))
    informative = weights != DRIFT  # all others weigh as much as unknown ones
    model = Model(tokens[informative], weights[informative], 1.0, 0.0, np.zeros(3))
    return calibrate(model, sample, sizes)


def _clean_weights(model: Model):
    """How often each weight occurs in clean sample texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.round(model.token_weights(words, stems), 6) for _, words, stems, _ in _texts(batch)]
            values, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), pa.array(n, pa.int64())], ["weight", "n"])

    return run


def _segment_scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, sizes = [], []
            for _, words, stems, _ in _texts(batch):
                scores.append([s for _, _, s in maximal_segments(model.token_weights(words, stems))])
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(sizes, pa.int64()), pa.array(scores, pa.list_(pa.float64()))], ["label", "n", "scores"])

    return run


def calibrate(model: Model, sample: DataFrame, sizes: dict[int, int]) -> Model:
    """Fit the law to the weights and best segments of clean sample texts (text, label), then the logistic curve to all.

    The texts are read in tasks; what comes to the driver are the weights' counts and the segments' scores.
    """
    prior = float(np.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5)))
    weights = sample.filter("label = 0").select("text").mapInArrow(_clean_weights(model), "weight double, n bigint").groupBy("weight").agg(F.sum("n").alias("n")).toPandas()
    found = sample.select("text", "label").mapInArrow(_segment_scores(model), "label int, n bigint, scores array<double>").toPandas()
    labels = found["label"].to_numpy(np.int64)
    if len(set(labels.tolist())) < 2:
        model.curve = np.array([prior if len(labels) else 0.0, 0.0, 0.0])
        return model
    if len(weights):
        model.rate = extreme_value_rate(weights["weight"].to_numpy(), weights["n"].to_numpy() / weights["n"].sum())
    rows = [(list(s), max(int(n), 1)) for s, n in zip(found["scores"], found["n"], strict=True)]
    clean = [model.rate * max(s) - np.log(n) for (s, n), y in zip(rows, labels, strict=True) if y == 0 and s]
    # The mean of a standard extreme-value law is Euler's constant.
    model.log_k = float(np.mean(clean) - 0.5772) if clean else 0.0
    best, total = (np.array(x) for x in zip(*[_evidence(s, n, model.rate, model.log_k) for s, n in rows], strict=True))
    model.curve = _logistic(_inputs(best, total), labels.astype(float))
    model.curve[0] += prior - np.log(np.sum(labels == 1) / np.sum(labels == 0))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score``, ``passages`` of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``passages`` are the significant segments, as ``start`` and ``end`` in code points of the text, ``score`` and
    ``expected`` number by chance. Whole texts are read; a null or empty text has no segment and scores as such.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            best, total, passages = [], [], []
            for row, words, stems, block in _texts(batch):
                r = row - block.first_row
                first = block.bounds[r]
                found = maximal_segments(m.token_weights(words, stems))
                x, y = _evidence([s for _, _, s in found], len(words), m.rate, m.log_k)
                best.append(x)
                total.append(y)
                kept = []
                for a, b, s in found:
                    expected = float(np.exp(min(50.0, np.log(max(len(words), 1)) + m.log_k - m.rate * s)))
                    if expected <= SIGNIFICANT:
                        chars = [_code_points(block, r, at) for at in (block.starts[first + a], block.ends[first + b - 1])]
                        kept.append({"start": chars[0], "end": chars[1], "score": s, "expected": expected})
                passages.append(kept)
            values = sigmoid(_inputs(np.array(best), np.array(total)) @ m.curve)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"]
            )

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = "doc_id bigint, score double, passages array<struct<start:bigint,end:bigint,score:double,expected:double>>"
    return spread(docs, docs).mapInArrow(run, out)


def _code_points(block, row: int, at: int) -> int:
    """Code points of the row's text before byte ``at``."""
    part = block.data[block.row_bytes[row] : at]
    return int(np.count_nonzero((part & 0xC0) != 0x80))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, fit(docs, labels))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", predicted, F.size("passages").cast("long").alias("n_passages"))


QUERIES = {"op1_toxicity": op1_toxicity}
SQL: dict[str, str] = {}
