"""Merge replay against the tiktoken library, exact round trips, odd rows and the corpus's table."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from farelens.llm import bpe

POOLS = ["ab", "abc ", "aeiothnsr", "абвг ", "日本語 ", "  \n\t'sdtlvremx", "0123 ", "!?.,=-", "🙂é́₏⃁ ", "".join(map(chr, range(0, 1000)))]


@pytest.fixture(scope="module")
def known():
    return bpe.Vocabulary()


@pytest.fixture(scope="module")
def library(known):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.ranks, special_tokens={})


def some_texts(n, seed=7):
    draw = random.Random(seed)
    for _ in range(n):
        pool = draw.choice(POOLS + ["".join(POOLS)])
        yield "".join(draw.choice(pool) for _ in range(draw.choice([0, 1, 3, 12, 60, 400])))


def test_equals_the_library(known, library):
    for text in some_texts(3000):
        assert known.encode_ordinary(text) == library.encode_ordinary(text)
    for text in ("a" * 50_000, " " * 30_000, "ab" * 20_000 + "=" * 9_999, "<|endoftext|> x"):
        assert known.encode_ordinary(text) == library.encode_ordinary(text)


def test_lower_rank_made_by_a_merge():
    """A vocabulary in which merging makes pairs of lower ranks than the merge itself."""
    draw = random.Random(3)
    for _ in range(300):
        known = bpe.Vocabulary.__new__(bpe.Vocabulary)
        known.ranks = {bytes([b]): b for b in range(256)}
        tokens = {"".join(draw.choice("ab") for _ in range(draw.randint(2, 5))).encode() for _ in range(12)}
        for token in draw.sample(sorted(tokens), len(tokens)):
            known.ranks[token] = len(known.ranks)
        known.size, known.pairs = len(known.ranks), {}
        known.tokens = sorted(known.ranks, key=known.ranks.get)
        known.of_byte = np.arange(256)
        known.byte_pairs = np.full(1 << 16, -1, np.int64)
        for token, rank in known.ranks.items():
            if len(token) == 2:
                known.byte_pairs[token[0] << 8 | token[1]] = rank
        words = ["".join(draw.choice("ab") for _ in range(draw.randint(1, 14))).encode() for _ in range(30)]
        assert bpe.replay(words, known) == [one_by_one(w, known.ranks) for w in words]


def one_by_one(word, ranks):
    """The plain rule: again and again merge the adjacent pair of the lowest rank, the leftmost of equal ones."""
    parts = [word[k : k + 1] for k in range(len(word))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_documents(spark, library):
    texts = [None, "", " ", "\n \t", *some_texts(60), "w " * 30_000, "x" * 20_000, "same", "same"]
    rows = [(k if k % 9 else None, t, "other", 3) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n bigint")
    table = bpe.word_table(docs, most=50)
    assert 0 < len(table.keys) <= 50
    want = sorted((k if k % 9 else -1, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in enumerate(texts))
    for given in (None, spark.sparkContext.broadcast(table)):
        both = bpe.encode(docs, table=given, decoded=True)
        assert bpe.decode(bpe.encode(docs, table=given)).exceptAll(both).count() == 0
        got = both.collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == want
    assert bpe.encode(docs.filter("doc_id < 0")).count() == 0
    assert len(bpe.word_table(docs.filter("doc_id < 0")).keys) == 0


def test_query_on_the_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in bpe.op13_bpe(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = np.array(library.encode_ordinary(row["text"] or ""), "<u4")
        found = got[row["doc_id"]]
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_many_places_of_a_rank_are_merged_together(known, monkeypatch):
    """Words that share their pairs are looked up by pair, not by place, and the ids do not depend on the way."""

    class Counted(dict):
        looked_up = 0

        def get(self, key, default=None):
            Counted.looked_up += 1
            return super().get(key, default)

    draw = random.Random(11)
    parts = ["".join(draw.choice("bdklmnrst") + draw.choice("aeiou") for _ in range(2)) for _ in range(60)]
    words = sorted({" " + "".join(draw.choice(parts) for _ in range(3)) for _ in range(5000)})
    words += ["", "aaaaaaa", " " * 9, "日本語日本語", *(draw.choice("ab") * draw.randint(1, 6) for _ in range(300))]
    want = [one_by_one(w.encode(), known.ranks) for w in words]
    monkeypatch.setattr(known, "pairs", Counted(known.pairs))
    for many in (bpe._MANY, 1, 10**9):
        monkeypatch.setattr(bpe, "_MANY", many)
        Counted.looked_up = 0
        assert bpe.replay([w.encode() for w in words], known) == want
        assert many == 10**9 or Counted.looked_up < 3 * len(words)
