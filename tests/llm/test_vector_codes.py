"""Integer codebooks against whole distances in Python integers, odd rows, and the query against its SQL."""

import hashlib
import random

import numpy as np
import pytest

from farelens.llm import vector_codes
from tests.compare import compare, connect

FIELDS = "vec_id bigint, embedding array<double>, label int, code string, error string"


def by_hand(rows, parts=8, entries=16, rounds=6):
    """The rule with whole squared distances, one vector at a time."""
    kept = [(i, x, label) for i, x, label in rows if x and all(v is not None and np.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    width = -(-size // parts)

    def cut(x):
        whole = [int(v) * 4096 if abs(v) > 2**52 else int(np.floor(v * 4096)) for v in x] + [0] * (width * parts - size)
        return [whole[k * width : (k + 1) * width] for k in range(parts)]

    vectors = [cut(x) for _, x, _ in kept]
    books = [[v[p] for v in vectors[:entries]] for p in range(parts)]

    def assign(v):
        found = []
        for p in range(parts):
            distances = [sum((a - b) ** 2 for a, b in zip(v[p], e, strict=True)) for e in books[p]]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        codes = [assign(v) for v in vectors]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, c in zip(vectors, codes, strict=True) if c[p][0] == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    out = []
    for (i, _, label), v in zip(kept, vectors, strict=True):
        codes = assign(v)
        out.append((i, "".join(f"{c:02x}" for c, _ in codes), sum(d for _, d in codes), label))
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    return sorted((repr(i), code, min(error, 2**63 - 1), min(totals[label], 2**63 - 1), digest) for i, code, error, label in out)


def check(spark, rows):
    df = spark.createDataFrame([(i, x, label, "c", "e") for i, x, label in rows], FIELDS).repartition(5)
    got = sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_codes.compress(df).collect())
    assert got == by_hand(rows)


def test_nearest_equals_whole_distances():
    draw = np.random.default_rng(1)
    for width in (1, 2, 3, 5, 8, 16):
        x, e = draw.integers(-3, 4, (400, width)), draw.integers(-3, 4, (9, width))
        whole = ((x[:, None] - e[None]) ** 2).sum(axis=2)
        power = 1 << (width - 1).bit_length()
        for kind in (np.int64, object):
            index, scaled = vector_codes.nearest(vector_codes.walsh(x.astype(kind)), vector_codes.walsh(e.astype(kind)))
            assert (index == whole.argmin(axis=1)).all() and (scaled == power * whole.min(axis=1)).all()


def test_sequency_order():
    basis = vector_codes.walsh(np.eye(16, dtype=np.int64)).T
    assert [int(np.count_nonzero(np.diff(row))) for row in basis] == list(range(16))


def test_odd_rows(spark):
    draw = random.Random(4)
    vector = lambda n=16: [draw.choice([0.0, 0.25, -0.3, 1.0, draw.gauss(0, 1)]) for _ in range(n)]
    rows = [(k, vector(), draw.choice([1, 2, None])) for k in range(3, 90)]
    rows += [(k, rows[0][1], 1) for k in range(100, 140)]
    rows += [(5, vector(), 2), (5, vector(), 2), (None, vector(), None), (200, None, 1), (201, [], 1), (202, [float("nan")] * 16, 1)]
    rows += [(203, [float("inf")] + [0.0] * 15, 1), (204, [None] + [0.0] * 15, 1), (205, [1.0] * 8, 1)]
    check(spark, rows)
    check(spark, [(k, vector(11), 1) for k in range(40)])  # parts of two, the last ones padded
    check(spark, rows[:5])  # fewer vectors than entries


def test_numbers_beyond_64_bits(spark):
    draw = random.Random(5)
    check(spark, [(k, [draw.choice([-1, 1]) * 10 ** draw.uniform(-3, 30) for _ in range(8)], k % 2) for k in range(60)])
    check(spark, [(k, [draw.gauss(0, 1) * 2.0**45 for _ in range(16)], 0) for k in range(40)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], FIELDS)
    assert vector_codes.compress(empty).count() == 0


def test_reconstruction(spark):
    rows = [(k, [float((k * j) % 7) for j in range(8)], 0) for k in range(16)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    books = vector_codes.train(df)
    got = vector_codes.reconstruct(vector_codes.encode(df, books), books).collect()
    assert {r["vec_id"]: r["embedding"] for r in got if r["error"] == 0} == {i: x for i, x, _ in rows}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert compare(spark, connect(folder), "op11_vector_codes", vector_codes.op11_vector_codes, vector_codes.SQL["op11_vector_codes"], folder) is None
