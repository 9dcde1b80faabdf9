"""License scans: a trained paragraph classifier over word n-grams, with DataFrame functions only.

A sparse logistic regression with one class for each licence family and one for everything else is trained on the
template sentences below, in many shortened and merged forms, against ordinary paragraphs. Its weights are few, so
paragraphs without any word that speaks for a family are settled by one pattern; the others are cut into n-grams,
which are joined with the weights. A prediction stands if its probability, on a scale set with paragraphs the model
was not trained on, beats the unknown class, and if enough of one of the family's templates is found in the
paragraph. A paragraph is a line, or the text around the end of a line that goes on in the next one: a sentence that
is wrapped, at any width, stands whole in the joined text of the line in which it begins.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import broadcast_if_bounded, materialize

# Opening or typical sentences of public licences, and one-line notices that name them.
TEMPLATES = {
    "apache": (
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        "you may obtain a copy of the license at http www apache org licenses license 2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "licensed under the apache license version 2.0",
        "spdx license identifier apache 2.0",
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "released under the mit license",
        "licensed under the mit license",
        "spdx license identifier mit",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",
        "licensed under the bsd 3 clause license",
        "use of this source code is governed by a bsd style license",
        "spdx license identifier bsd 3 clause",
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "you should have received a copy of the gnu general public license along with this program",
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu lesser general public license version 2.1",
        "spdx license identifier gpl 3.0 or later",
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2.0",
        "licensed under the mozilla public license version 2.0",
        "spdx license identifier mpl 2.0",
    ),
    "creative_commons": (
        "this work is licensed under a creative commons attribution 4.0 international license",
        "licensed under the creative commons attribution sharealike license cc by sa 4.0",
        "this text is available under the creative commons attribution noncommercial license cc by nc 4.0",
        "to view a copy of this license visit http creativecommons org licenses by 4.0",
        "licensed under cc by 4.0",
        "licensed under cc by nc 4.0",
        "licensed under cc by sa 4.0",
        "spdx license identifier cc by 4.0",
    ),
    "public_domain": (
        "this is free and unencumbered software released into the public domain",
        "dedicated to the public domain under cc0 1.0 universal",
        "spdx license identifier cc0 1.0",
    ),
    "proprietary": (
        "all rights reserved no part of this publication may be reproduced without prior written permission of the publisher",
        "this software is proprietary and confidential unauthorized copying of this file is strictly prohibited",
        "copyright all rights reserved",
    ),
}
UNKNOWN = "unknown"
CLASSES = (UNKNOWN, *TEMPLATES)

#: Paragraphs for the unknown class, at most, those with the smallest hashes; half of them set the scale of the output.
UNKNOWN_SAMPLE = 4_000
#: Features with a weight, at most. They are joined by broadcast.
MAX_FEATURES = 5_000
#: Shares of paragraphs that count as known: the probability, and the part of a template's words that is found.
PROBABILITY = 0.5
CONFIRMED = 0.6
#: Words that are joined from either side of a line's end: no template is longer.
REACH = max(len(text.split()) for texts in TEMPLATES.values() for text in texts)
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Steps, step size and penalty of the training.
_EPOCHS, _RATE, _SPARSE = 300, 0.5, 2e-4


def grams(words: list[str]) -> list[str]:
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def _examples(seed: int) -> list[tuple[list[str], int]]:
    """Templates whole, shortened at either end, and with a few words lost."""
    rng = np.random.default_rng(seed)
    out = []
    for k, texts in enumerate(TEMPLATES.values(), 1):
        for text in texts:
            words = text.split()
            out.append((words, k))
            for _ in range(6):
                a = int(rng.integers(0, max(1, len(words) // 4)))
                b = len(words) - int(rng.integers(0, max(1, len(words) // 4)))
                out.append(([w for w in words[a:b] if rng.random() > 0.08], k))
    return out


class Model:
    """``rows``: (feature, class, weight); ``bias`` and ``scale`` of the classes' logits; ``gate``: pattern of telling words."""

    def __init__(self, rows, bias, scale, gate):
        self.rows, self.bias, self.scale, self.gate = rows, bias, scale, gate


def train(unknown: list[str], seed: int = 11) -> Model:
    """Multinomial logistic regression with a penalty that makes weights vanish, on templates and ``unknown`` paragraphs."""
    texts = [re.findall(WORD, t.lower()) for t in unknown]
    learn, tune = texts[::2], texts[1::2]
    known = _examples(seed)
    # Words that ordinary paragraphs are full of tell nothing by themselves.
    common: dict[str, int] = {}
    for words in learn:
        for w in set(words):
            common[w] = common.get(w, 0) + 1
    usual = {w for w, n in common.items() if n > max(5, 0.01 * len(learn))}
    counts: dict[str, int] = {}
    for words, _ in known:
        for g in set(grams(words)):
            counts[g] = counts.get(g, 0) + 1
    features = sorted((g for g, n in counts.items() if n >= 2 and not all(w in usual for w in g.split())), key=lambda g: (-counts[g], g))[:MAX_FEATURES]
    place = {g: k for k, g in enumerate(features)}

    def matrix(rows):
        x = np.zeros((len(rows), len(features)), np.float32)
        for i, words in enumerate(rows):
            for g in set(grams(words)):
                if g in place:
                    x[i, place[g]] = 1.0
        return x

    # Ordinary paragraphs without any feature all look alike: one row with their number.
    plain = matrix(learn)
    odd = plain.any(axis=1)
    x = np.concatenate([matrix([w for w, _ in known]), plain[odd], np.zeros((1, len(features)), np.float32)])
    y = np.array([k for _, k in known] + [0] * int(odd.sum()) + [0])
    weight = np.array([1.0] * (len(known) + int(odd.sum())) + [max(1.0, float((~odd).sum()))])
    weight[y == 0] *= len(known) / max(weight[y == 0].sum(), 1)
    w, b = np.zeros((len(features), len(CLASSES)), np.float32), np.zeros(len(CLASSES), np.float32)
    hot = np.eye(len(CLASSES), dtype=np.float32)[y]
    for _ in range(_EPOCHS):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - hot) * (weight / weight.sum())[:, None]
        w -= 20 * _RATE * (x.T @ g).astype(np.float32)
        b -= 20 * _RATE * g.sum(axis=0).astype(np.float32)
        w = np.sign(w) * np.maximum(np.abs(w) - 20 * _RATE * _SPARSE, 0)
    # One scale for all logits: the largest for which held-back paragraphs and fresh examples are most likely.
    fresh = _examples(seed + 1)
    z = np.concatenate([matrix([t for t, _ in fresh]), matrix(tune)]) @ w + b
    truth = np.array([k for _, k in fresh] + [0] * len(tune))

    def loss(s):
        q = s * z
        q = q - q.max(axis=1, keepdims=True)
        return -np.mean((q - np.log(np.exp(q).sum(axis=1, keepdims=True)))[np.arange(len(truth)), truth])

    scale = min((float(s) for s in np.geomspace(0.25, 8, 26)), key=loss)
    rows = [(features[i], CLASSES[k], float(w[i, k])) for i, k in zip(*np.nonzero(w), strict=True)]
    telling = sorted({word for f, c, v in rows if c != UNKNOWN and v > 0 for word in f.split() if word not in usual})
    gate = r"(?<![a-z0-9])(?:" + "|".join(map(re.escape, telling)) + r")(?![a-z0-9])" if telling else "(?!)"
    return Model(rows, dict(zip(CLASSES, b.tolist(), strict=True)), scale, gate)


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``paragraph`` (its number), ``text`` of all lines that are not blank; a null text has none."""
    lines = docs.filter("doc_id is not null and text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "text"))
    return lines.filter(F.trim("text") != "")


def _line_words(text: Column) -> Column:
    """The words of each line, without marks of a comment; a line of nothing else has none."""
    return F.transform(F.split(text, "\n", -1), lambda x: _words(F.regexp_replace(x, r"^\s*(?i:rem|dnl)\s", "")))


def joined_and_single(docs: DataFrame) -> DataFrame:
    """The rows of ``paragraphs`` and ``doc_id``, ``paragraph``, ``text`` of the words around each end of a line that goes on.

    They are the last REACH words of the line and the first REACH words after it, up to the next line without a word.
    ``paragraph`` is -1 less the line's number.
    """
    docs = docs.filter("doc_id is not null and text is not null")
    single = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("paragraph"), x.alias("text"))), lambda x: F.trim(x["text"]) != "")

    def joined(w):
        heads = F.transform(w, lambda x: F.slice(x, 1, REACH))

        def at(h):
            def one(i):
                after = F.slice(h, i + 2, REACH)
                gap = F.array_position(F.transform(after, lambda x: F.size(x) == 0), F.lit(True)).cast("int")
                after = F.slice(F.flatten(F.when(gap > 0, F.slice(after, F.lit(1), gap - 1)).otherwise(after)), 1, REACH)
                before = F.element_at(w, i + 1)
                before = F.slice(before, F.greatest(F.size(before) - (REACH - 1), F.lit(1)), F.lit(REACH))
                return F.struct((-1 - i).alias("paragraph"), F.array_join(F.concat(before, after), " ").alias("text"))

            goes_on = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i < F.size(w) - 1) & (F.size(F.get(h, i)) > 0) & (F.size(F.coalesce(F.get(h, i + 1), F.array().cast("array<string>"))) > 0))
            return F.transform(goes_on, one)

        return F.flatten(F.transform(F.array(heads), at))

    over = F.flatten(F.transform(F.array(_line_words(F.col("text"))), joined))
    return docs.select("doc_id", F.inline(F.concat(single, over)))


def fit(docs: DataFrame) -> Model:
    """Train against at most UNKNOWN_SAMPLE distinct paragraphs that name no licence or copyright."""
    lines = paragraphs(docs).filter(~F.lower("text").rlike("licen[cs]e|copyright|all rights|public domain|creative commons|redistribut|spdx|cc0"))
    # The draw is by content: copies of a paragraph are one, and partitions do not matter.
    keyed = lines.select(F.xxhash64("text").alias("h"), "text").filter(F.col("h") % 16 == 0)
    few = _least(keyed).collect()
    if len(few) < 100:
        few = _least(lines.select(F.xxhash64("text").alias("h"), "text")).collect()
    return train([r["text"] for r in sorted(few, key=lambda r: (r["h"], r["text"]))])


def _least(keyed: DataFrame) -> DataFrame:
    """UNKNOWN_SAMPLE different texts, those with the smallest hashes: copies are folded before the draw."""
    return keyed.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(UNKNOWN_SAMPLE)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def classify(lines: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``paragraph``, ``family``, ``probability``, ``template``, ``found`` of paragraphs that a licence is found in.

    ``template`` is the number of the best template of the family, ``found`` the share of its n-grams in the
    paragraph. Others than these are unknown: settled by the gate, by the probability or by the comparison.
    """
    spark = lines.sparkSession
    gated = lines.filter(F.lower("text").rlike(model.gate)).select("doc_id", "paragraph", _words(F.col("text")).alias("words"))
    pairs = F.transform(F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.element_at("words", i + 1), w))
    gated = materialize(gated.select("doc_id", "paragraph", F.array_distinct(F.concat("words", pairs)).alias("grams")), "license-paragraphs")
    weights = spark.createDataFrame([(f, c, v) for f, c, v in model.rows] or [("", UNKNOWN, 0.0)], "gram string, family string, weight double")
    by_gram = weights.groupBy("gram").agg(F.collect_list(F.struct("family", "weight")).alias("weights"))
    votes = gated.select("doc_id", "paragraph", F.explode("grams").alias("gram")).join(broadcast_if_bounded(by_gram, MAX_FEATURES), "gram")
    votes = votes.select("doc_id", "paragraph", F.inline("weights"))
    sums = [F.sum(F.when(F.col("family") == c, F.col("weight")).otherwise(0.0)).alias(c) for c in CLASSES]
    logits = votes.groupBy("doc_id", "paragraph").agg(*sums)
    scaled = [F.struct((model.scale * (F.col(c) + model.bias[c])).alias("z"), F.lit(c).alias("family")) for c in CLASSES]
    logits = logits.select("doc_id", "paragraph", F.array(*scaled).alias("z")).withColumn("best", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x["z"] - F.col("best")["z"]))
    likely = logits.select("doc_id", "paragraph", F.col("best.family").alias("family"), (1 / total).alias("probability"))
    likely = likely.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= PROBABILITY))
    templates = [(c, k, sorted(set(grams(t.split())))) for c, texts in TEMPLATES.items() for k, t in enumerate(texts)]
    templates = F.broadcast(spark.createDataFrame(templates, "family string, template int, parts array<string>"))  # the table above
    compared = likely.join(gated, ["doc_id", "paragraph"]).join(templates, "family")
    share = F.size(F.array_intersect("grams", "parts")) / F.size("parts")
    best = compared.withColumn("found", share).groupBy("doc_id", "paragraph", "family", "probability").agg(F.max(F.struct("found", -F.col("template"))).alias("t"))
    return best.select("doc_id", "paragraph", "family", "probability", (-F.col("t.col2")).alias("template"), F.col("t.found").alias("found")).filter(F.col("found") >= CONFIRMED)


def scan_licenses(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id``, ``n_paragraphs``, ``n_licenses``, ``families`` (sorted, comma-joined) of every row of ``docs`` with a doc_id.

    ``n_paragraphs`` counts lines that are not blank. ``n_licenses`` counts the lines that a licence is found in, and
    each stretch of consecutive lines with words once for a family that is found over the ends of its lines only. A
    null, empty or blank text has no paragraphs. Extra columns are ignored, repeated paragraphs count each.
    """
    docs = docs.select("doc_id", "text")
    model = model or fit(docs)
    # Joining makes no new words, so only texts with a telling one are looked at.
    found = classify(joined_and_single(docs.filter(F.lower("text").rlike(model.gate))), model)
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("paragraph", "family")).alias("hits"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.trim(x) != "")
    out = docs.filter("doc_id is not null").select("doc_id", "text", F.size(lines).cast("bigint").alias("n_paragraphs")).join(found, "doc_id", "left")

    def count(w):
        gaps = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.size(F.get(w, i)) == 0)
        placed = F.transform(
            "hits",
            lambda x: F.struct(
                (x["paragraph"] < 0).alias("joined"),
                F.size(F.filter(gaps, lambda g: g < F.when(x["paragraph"] < 0, -1 - x["paragraph"]).otherwise(x["paragraph"]))).alias("stretch"),
                x["family"].alias("family"),
            ),
        )

        def total(p):
            key = lambda x: F.struct(x["stretch"], x["family"])
            whole, over = F.filter(p, lambda x: ~x["joined"]), F.filter(p, lambda x: x["joined"])
            return F.size(whole) + F.size(F.array_except(F.transform(over, key), F.transform(whole, key)))

        return F.element_at(F.transform(F.array(placed), total), 1)

    n = F.element_at(F.transform(F.array(_line_words(F.col("text"))), count), 1)
    families = F.array_join(F.array_sort(F.array_distinct(F.col("hits.family"))), ",")
    return out.select(
        "doc_id",
        "n_paragraphs",
        F.when(F.col("hits").isNull(), 0).otherwise(n).cast("bigint").alias("n_licenses"),
        F.coalesce(families, F.lit("")).alias("families"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_licenses": op6_licenses}
SQL: dict[str, str] = {}
