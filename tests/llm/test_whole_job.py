"""Cases that earlier versions of the operators for training data left out."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from farelens.llm import embedding_join, licenses, line_runs, ngram_join, passages, phrase_index


def fresh_words(seed):
    rng = random.Random(seed)
    return lambda n: [f"{rng.randrange(10**9)}" for _ in range(n)]


def test_long_single_lines_are_repeats_in_the_pipeline(spark):
    fresh = fresh_words(1)
    long, short = " ".join(fresh(20)), " ".join(fresh(19))
    texts = [f"a\n{long}\nb\n{short}\nc", f"d\n{long}\ne\n{short}\nf", long, short, f"g\nd\n{long}\n\ne\n{long}", None, ""]
    df = spark.createDataFrame([(k, t, len(t or "")) for k, t in enumerate(texts)] + [(None, long, 5)], "doc_id bigint, text string, n_chars bigint")
    got = {r["doc_id"]: r["text"] for r in line_runs.drop_lines(spark, df, "").collect()}
    assert got == {0: texts[0], 1: f"d\ne\n{short}\nf", 3: short, 4: "g\n", 5: None, 6: "", None: long}
    runs = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in line_runs.repeated_runs(df, 2, 20).collect()}
    assert runs == {1: [(1, 1, 0, 1)], 2: [(0, 1, 0, 1)], 4: [(1, 3, 1, 0), (4, 1, 0, 1)]}


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_wrapped_licenses_are_found(spark):
    rng = random.Random(2)
    plain = [" ".join(rng.choice("sun rain the of wind a moon 3.0 tree any".split()) for _ in range(20)) for _ in range(300)]
    bare = "spdx license\n\nidentifier mit"
    narrow = "\n".join(f"// {w}" for w in "Licensed under the BSD 3 Clause License".split())
    texts = [BSD, "\n".join([plain[0], *(f" * {x}" for x in GPL.split("\n")), plain[1]]), narrow, bare, "\n".join(plain[:50]), "Released under the MIT License.\nReleased under the MIT License."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_licenses"], r["families"]) for r in licenses.scan_licenses(df, licenses.train(plain)).collect()}
    assert got == {0: (2, "bsd"), 1: (1, "gpl"), 2: (1, "bsd"), 3: (0, ""), 4: (0, ""), 5: (2, "mit")}


def test_copies_do_not_fill_the_license_sample(spark, monkeypatch):
    monkeypatch.setattr(licenses, "UNKNOWN_SAMPLE", 120)
    seen = []
    monkeypatch.setattr(licenses, "train", lambda texts: seen.extend(texts))
    rows = [f"line {k}" for k in range(3000)]
    licenses.fit(spark.createDataFrame([(k, t) for k, t in enumerate(rows + [x for x in rows for _ in range(3)])], "doc_id bigint, text string"))
    assert len(set(seen)) == len(seen) == 120


def _passage_pairs(spark, texts):
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in texts], "doc_id bigint, text string")
    return {(r["doc_id"], r["from_doc"], r["start"], r["end"]) for r in passages.repeated_passages(df).collect()}


def test_passage_with_parts_in_earlier_documents(spark):
    fresh = fresh_words(3)
    shared, long = fresh(80), fresh(400)
    texts = [(1, [*shared[:40], *fresh(30)]), (2, [*fresh(30), *shared[40:]]), (50, [*fresh(5), *shared, *fresh(9)]), (60, [*fresh(7), *shared, *fresh(3)])]
    # The outer parts of a long passage stand in two documents each, so that only its middle is linked.
    texts += [(70, [*fresh(9), *long, *fresh(9)]), (71, [*long[:170], *fresh(9)]), (72, [*fresh(9), *long[230:]]), (3, long[:170]), (4, long[230:]), (90, [*fresh(4), *long, *fresh(6)])]
    got = _passage_pairs(spark, texts)
    assert (60, 50, 7, 87) in got and (90, 70, 4, 404) in got


def test_passage_whose_parts_stand_in_documents_before_and_after(spark):
    fresh = fresh_words(12)
    texts, want = [], set()
    for k, n in enumerate((50, 60, 80)):
        shared, base = fresh(n), 100 * k
        # Parts of the passage stand in the first documents and in the ones just before, so no seed is matched with base + 50.
        parts = [shared[i : i + 28] for i in range(0, n - 24, 16)]
        texts += [(base + d + i, [*fresh(9), *x, *fresh(9)]) for d in (1, 60) for i, x in enumerate(parts)]
        texts += [(base + 50, [*fresh(5), *shared, *fresh(8)]), (base + 90, [*fresh(7), *shared, *fresh(4)])]
        want.add((base + 90, base + 50, 7, 7 + n))
    assert _passage_pairs(spark, texts) == want


def test_changed_passage_whose_parts_all_stand_in_other_documents(spark):
    fresh, texts = fresh_words(14), []
    # The second passage has two words more after some of its parts, so that its places do not keep their distance.
    for base, more in ((0, ()), (100, (19, 39))):
        shared = fresh(60)
        # Every seed of the passage stands in a document before the 50th and in one after it, too.
        texts += [(base + d + i // 10, [*fresh(30), *shared[i : i + 9], *fresh(30)]) for d in (1, 60) for i in range(0, 60, 10)]
        changed = [y for i, x in enumerate(shared[:59]) for y in [fresh(1)[0] if i % 10 == 9 else x, *fresh(2 * (i in more))]]
        texts += [(base + 50, [*fresh(5), *shared, *fresh(8)]), (base + 90, [*fresh(7), *changed, *fresh(40)])]
    assert _passage_pairs(spark, texts) == {(90, 50, 7, 66), (190, 150, 7, 70)}


def test_changed_passage_at_a_later_place_of_its_document(spark):
    fresh = fresh_words(15)
    shared = fresh(60)
    # The seeds stand one by one at the beginning of the earlier document, which is their first place there.
    parts = [y for i in range(0, 60, 10) for j in range(i, i + 6) for y in [*shared[j : j + 4], *fresh(9)]]
    changed = [fresh(1)[0] if i % 10 == 9 else x for i, x in enumerate(shared)][:59]
    texts = [(1, [*parts, *fresh(9), *shared, *fresh(9)]), (2, [*fresh(20), *changed, *fresh(20)])]
    assert (2, 1, 20, 79) in _passage_pairs(spark, texts)


def test_texts_of_words_over_and_over_give_few_passages(spark):
    fresh = fresh_words(13)
    for word in (["w"], ["w", "v"]):
        texts = [(1, [*fresh(20), *word * (400 // len(word)), *fresh(20)]), (2, [*fresh(30), *word * (300 // len(word)), *fresh(10)])]
        texts += [(3, [*fresh(5), *word * (1000 // len(word)), *fresh(5)])]
        got = _passage_pairs(spark, texts)
        # One passage for each time that the earlier text is at its end, not one for each run of 50 words.
        assert [x for x in got if x[0] == 2] == [(2, 1, 30, 330)] and len(got) <= 6
        for k in range(5, 1005 - passages.MIN_WORDS):
            assert any(doc == 3 and start <= k and k + passages.MIN_WORDS <= end for doc, _, start, end in got)


def test_fuzzy_short_passages_are_seeded(spark):
    fresh = fresh_words(4)
    texts, want = [], set()
    for k, step in enumerate((5, 6, 8, 10, 12)):
        words = fresh(61)
        edited = [x if i % step != step - 1 else fresh(1)[0] for i, x in enumerate(words)]
        texts += [(2 * k, [*fresh(20), *words, *fresh(20)]), (2 * k + 1, [*fresh(20), *edited, *fresh(20)])]
        want.add((2 * k + 1, 2 * k))
    assert {x[:2] for x in _passage_pairs(spark, texts)} == want


def test_passages_with_changes_at_random_places_are_found(spark):
    fresh, rng = fresh_words(6), random.Random(6)
    for changed in (10, 12):  # of 60 words, the latter just at the least identity
        texts = []
        for k in range(60):
            words = fresh(60)
            places = set(rng.sample(range(60), changed))
            edited = [fresh(1)[0] if i in places else x for i, x in enumerate(words)]
            texts += [(2 * k, [*fresh(80), *words, *fresh(80)]), (2 * k + 1, [*fresh(80), *edited, *fresh(80)])]
        got = _passage_pairs(spark, texts)
        assert {x[:2] for x in got} <= {(2 * k + 1, 2 * k) for k in range(60)}
        assert len({x[:2] for x in got}) >= 54


def test_copies_are_one_passage_from_the_first_text(spark):
    fresh = fresh_words(7)
    shared, short = fresh(55), fresh(49)
    whole = [*fresh(10), *shared, *fresh(10)]
    texts = [(1, shared), (4, whole), (5, whole), (6, whole), (7, short), (8, short), (9, [*fresh(3), *whole])]
    assert _passage_pairs(spark, texts) == {(4, 1, 10, 65), (5, 4, 0, 75), (6, 4, 0, 75), (9, 4, 3, 78), (9, 1, 13, 68)}


def test_seeds_over_many_partitions_keep_their_links(spark):
    fresh = fresh_words(8)
    shared = fresh(52)
    rows = [(k, " ".join([*fresh(2), *shared, *fresh(2)])) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(16)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["doc_id"], r["from_doc"]) for r in passages.repeated_passages(df).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(k, 0) for k in range(1, 400)} <= got and {(k, k - 1) for k in range(2, 400)} <= got


def test_rows_without_id_stay_in_the_ngram_stage(spark):
    text = " ".join(fresh_words(5)(30))
    df = spark.createDataFrame([(1, text), (2, text), (None, text), (None, None)], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in ngram_join.keep_one(spark, df, "").collect())
    assert got == [(0, ""), (0, text), (1, text)]


def test_runs_are_maximal_whatever_the_earliest_copies(spark):
    texts = [(1, "x\nB\nC\ny"), (5, "A\nB\nC\nD"), (10, "A\nB\nC\nD"), (11, "C\nD\nz\nA\nB")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in line_runs.repeated_runs(df).collect()}
    assert got == {5: [(1, 2, 1, 1)], 10: [(0, 4, 5, 0)], 11: [(0, 2, 5, 2), (3, 2, 5, 0)]}


@pytest.mark.parametrize("tile", [40_000, 60])
def test_vectors_are_sent_once_for_a_part(spark, monkeypatch, tile):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 32))
    x[200:] = x[:200] + rng.normal(size=(200, 32)) * rng.uniform(0, 0.6, (200, 1))
    x[390:] = x[:10]  # copies
    label = rng.integers(0, 2, 400)
    label[200:] = label[:200]
    monkeypatch.setattr(embedding_join, "TILE", tile)
    sent, before = [], type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, *a, **b: (sent.append(df.count()) if "embedding" in df.columns else None, before(df, *a, **b))[1])
    rows = [(k, [float(v) for v in e], int(n)) for k, (e, n) in enumerate(zip(x, label, strict=True))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.near_vectors(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= embedding_join.COSINE) & (label[:, None] == label[None, :]) & ~np.eye(400, dtype=bool)
    assert linked.sum() > 150 and {k: n for k, (n, _) in got.items()} == dict(enumerate(linked.sum(axis=1).tolist()))
    part = np.arange(400)
    for _ in range(400):
        part = np.minimum(part, np.where(linked, part[None, :], 400).min(axis=1))
    assert {k: c for k, (_, c) in got.items()} == dict(enumerate(part.tolist()))
    # Not once for each cell of each block.
    assert sent and max(sent) <= 400 * (1 if tile > 400 else 5)


def test_phrase_index_has_small_row_groups(spark):
    # Readers and writers hold a row group; each of these rows is a segment of 400,000 words.
    text = "array_join(transform(sequence(1, 400000), x -> hex(x * 7919L + id)), ' ')"
    docs = spark.range(24).repartition(1).selectExpr("id as doc_id", f"{text} as text")
    index = phrase_index.build_index(docs)  # three in each of eight files
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    rows = [m.row_group(k).num_rows for m in groups for k in range(m.num_row_groups)]
    assert sum(rows) == 24 and max(rows) <= 2
    items = spark.createDataFrame([("a", " ".join(f"{x * 7919 + 3:x}" for x in range(200, 215))), ("b", "1EEF 3DDE"), ("c", "x y")], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in phrase_index.decontaminate(docs, items).collect()}
    assert got == {k: ((2, 1) if k == 0 else (15, 1) if k == 3 else (0, 0)) for k in range(24)}


def test_phrases_take_little_room():
    import tracemalloc

    rng = np.random.default_rng(3)
    items = [(str(k), rng.integers(-(2**62), 2**62, 100)) for k in range(2_000)]
    items += [("again", items[5][1][:30]), ("short", items[6][1][:4])]
    tracemalloc.start()
    words, starts, lengths, owners, bounds = phrase_index._phrases(items)
    used, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 200 * len(words) and used < 100 * len(words)
    assert len(starts) == 2_000 * 91 + 1 and np.diff(bounds).sum() == 2_000 * 91 + 21 + 1 and sorted(set(lengths.tolist())) == [4, 10]
    shared = [{items[k][0] for k in owners[a:b].tolist()} for a, b in zip(bounds, bounds[1:], strict=False) if b - a > 1]
    assert shared == [{"5", "again"}] * 21
