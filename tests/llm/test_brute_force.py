"""Operators against plain versions, and the registered queries against their SQL."""

import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from farelens.llm import components, licenses, ngram_join, packing, passages, quality, registry, secrets, toxicity, words
from tests.compare import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
@pytest.mark.parametrize("name", list(registry.statements()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, registry.queries()[name], registry.statements()[name], SF_DIR) is None


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in registry.queries()} == set(range(1, 14))


def test_words_and_windows():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB1 é\n.\t日") for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, ""]
    for inside, pattern in ((words.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (words.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        seen = {}
        for block in words.text_blocks(pa.array(texts), inside, limit=500):
            h = block.hashes()
            for r in range(block.n_rows):
                want = re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), texts[block.first_row + r] or ""))
                got = h[block.bounds[r] : block.bounds[r + 1]].tolist()
                assert len(got) == len(want)
                for w, x in zip(want, got, strict=True):
                    assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 500)] + [(7, 7)]
    root = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    assert {r["node"]: r["component_id"] for r in components.connected(df).collect()} == root


def test_overlaps():
    rng = np.random.default_rng(3)
    items = [np.unique(rng.integers(0, 400, rng.integers(1, 200))) for _ in range(60)]
    left, right = np.arange(0, 60, 2), np.arange(1, 60, 2)
    got = ngram_join.overlaps(items, left, right)
    assert all(got[i, j] == len(np.intersect1d(items[a], items[b])) for i, a in enumerate(left) for j, b in enumerate(right))


def test_maximal_segments():
    rng = np.random.default_rng(4)
    for _ in range(200):
        w = rng.integers(-3, 4, rng.integers(1, 25)).astype(float)
        got = {(a, b) for a, b, _ in toxicity.maximal_segments(w)}
        want, todo = set(), [(0, len(w))]
        while todo:  # the best segment, then the same on either side of it
            a, b = todo.pop()
            best = max(((w[i:j].sum(), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best and best[0] > 0:
                want.add(best[3:])
                todo += [(a, best[3]), (best[4], b)]
        total = lambda spans: sorted(round(w[a:b].sum(), 9) for a, b in spans)  # noqa: E731  ties may be cut elsewhere
        assert total(got) == total(want)


def test_packing_capacities():
    rng = np.random.default_rng(5)
    for rule in ("dot", "norm"):
        counts = {int(k): int(n) for k, n in zip(rng.permutation(np.arange(1, 101))[:30], rng.integers(1, 50, 30), strict=True)}
        plan = packing.pack_lengths(counts, packing.Capacity(100, 4, 6000 + 4000), rule)
        bins, seen = {}, {}
        for length, number, n, first, offset in plan:
            seen.setdefault(length, []).extend(range(number, number + n))
            for s in range(first, first + n):
                bins.setdefault(s, []).append((offset, length))
        assert {k: sorted(v) == list(range(counts[k])) for k, v in seen.items()} == dict.fromkeys(counts, True)
        for pieces in bins.values():
            pieces.sort()
            assert [o for o, _ in pieces] == [sum(x for _, x in pieces[:k]) for k in range(len(pieces))]
            assert sum(x for _, x in pieces) <= 100 and len(pieces) <= 4 and sum(x * x for _, x in pieces) <= 10_000


def test_encoder_equals_tokenizer():
    encoder, rng = packing.Encoder(packing.VOCABULARY), random.Random(6)
    alphabet = list("ab1 ,'\n\t 　 é語🙂\u0085s ") + ["  ", " a", "'s", " <|endoftext|>"]
    texts = ["", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000))]
    want = [e.ids for e in encoder.exact.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want


def test_chains_against_all_orders():
    rng = np.random.default_rng(7)
    for _ in range(150):
        n = int(rng.integers(1, 7))
        a, c, size = rng.integers(0, 60, n), rng.integers(0, 60, n), rng.integers(1, 10, n)
        rows = np.column_stack([a, a + size, c, c + size, size])
        order = sorted(range(n), key=lambda i: (rows[i, 0], rows[i, 2]))
        best = [0.0] * n
        for i in order:
            before = [best[j] - passages.GAP_COST * (rows[i, 0] - rows[j, 1] + rows[i, 2] - rows[j, 3]) for j in range(n) if rows[j, 1] <= rows[i, 0] and rows[j, 3] <= rows[i, 2]]
            best[i] = rows[i, 4] + max([0.0, *before])
        path = passages.chains(rows)[0]
        got = rows[path, 4].sum() - sum(passages.GAP_COST * (rows[y, 0] - rows[x, 1] + rows[y, 2] - rows[x, 3]) for x, y in zip(path, path[1:], strict=False))
        assert got == pytest.approx(max(best))


def test_fuzzy_passages_are_found(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"{rng.randrange(10**9)}" for _ in range(n)]
    passage = fresh(80)
    edited = [*passage[:30], "changed", *passage[31:50], "put", "in", *passage[50:]]
    texts = [fresh(100), [*fresh(40), *passage, *fresh(30)], [*fresh(10), *edited, *fresh(50)], fresh(300)]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    (row,) = passages.repeated_passages(df).collect()
    assert (row["doc_id"], row["from_doc"], row["start"], row["end"], row["from_start"], row["from_end"]) == (2, 1, 10, 92, 40, 120)


def test_secret_spans(spark):
    rng, parts = random.Random(9), ["password", "Token", "api_key", "=", ": ", "\"", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é🙂", " ", "secret=token: "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "blob_id int, text string")
    got = {r["blob_id"]: [tuple(x) for x in r["found"]] for r in secrets.scan(df, secrets.BASE).collect()}
    for k, t in enumerate(texts):
        want = [(r.kind, *m.span()) for r in secrets.BASE for m in re.finditer(r.pattern, t, re.ASCII) if len(m[r.group]) >= r.least]
        assert got[k] == want


def test_held_out_accuracy():
    rng = random.Random(10)
    good = ["".join(rng.choice(["lo ", "mi ", "ta ", "sun ", "rain "]) for _ in range(60)) for _ in range(150)]
    bad = ["".join(rng.choice(["@@ ", "## ", "lo ", "mi "]) for _ in range(60)) for _ in range(150)]
    y = np.array([1] * 100 + [0] * 100)
    model = quality.train(good[:100] + bad[:100], y, {0: 100, 1: 100})
    scores = model.scores(quality.mean_weights(pa.array(good[100:] + bad[100:]), model.weights))
    assert (scores[:50] >= 0.7).all() and (scores[50:] < 0.7).all()


def test_license_families(spark):
    rng = random.Random(11)
    plain = [" ".join(rng.choice("sun rain the of wind a moon 3.0 tree any".split()) for _ in range(20)) for _ in range(300)]
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "All of the wind"]
    df = spark.createDataFrame([(k, "\n".join([plain[k], x])) for k, x in enumerate(lines)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_licenses"], r["families"]) for r in licenses.scan_licenses(df, licenses.train(plain)).collect()}
    assert got == {0: (1, "apache"), 1: (1, "mit"), 2: (1, "gpl"), 3: (0, "")}


def test_pipeline(spark):
    import corpus_pipeline
    from farelens.session import materialize

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF_DIR), "stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_ngram_components_across_blocks(spark, monkeypatch):
    """Copies at all distances around the threshold, tiles of a few documents: every link counts, across blocks too."""
    monkeypatch.setattr(ngram_join, "TILE", 3)
    rng = np.random.default_rng(11)
    texts = []
    for base in range(4):
        words = rng.integers(0, 10_000, 150)
        for copy in range(30):
            own = words.copy()
            at = rng.choice(150, int(rng.integers(0, 9)) if copy else 0, replace=False)
            own[at] = rng.integers(0, 12, len(at)) if copy % 3 else rng.integers(0, 10_000, len(at))
            texts.append(" ".join(f"w{x}" for x in (own if copy % 5 else own[: 150 - 4 * (copy // 5)])))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs).collect()}
    assert 4 < len(set(root)) < len(texts)
    assert got == dict(enumerate(root))
