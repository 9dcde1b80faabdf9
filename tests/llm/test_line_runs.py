"""Deleted lines and runs against a plain search of all earlier places."""

import random

import pytest

from farelens.llm import line_runs


def some_documents(seed):
    draw = random.Random(seed)
    long = [" ".join(f"{w}{k}" for k in range(20)) for w in "pq"]
    pool = [*"ABCDE", *long, "", " \t"]
    texts = ["\n".join(draw.choice(pool) for _ in range(draw.randint(0, 14))) for _ in range(14)]
    texts += [texts[3] + "\n" + texts[5], texts[5] + "\nX\n" + texts[3], texts[4], texts[4]]
    return {k * 3 + 1: t for k, t in enumerate(texts)}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("min_lines, min_words", [(2, 20), (2, None), (3, None), (1, None)])
def test_runs_by_hand(spark, seed, min_lines, min_words):
    docs = {d: [x for x in t.split("\n") if x.strip(" \t")] for d, t in some_documents(seed).items()}
    df = spark.createDataFrame(list(some_documents(seed).items()), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (set(r["doomed"]), [tuple(x) for x in r["runs"]]) for r in line_runs.repeated_runs(df, min_lines, min_words).collect()}
    for doc, lines in docs.items():
        doomed = set()
        for at in range(len(lines)):
            for width in {min_lines, 1}:
                window = lines[at : at + width]
                if len(window) < width or (width < min_lines and (min_words is None or len(window[0].split()) < min_words)):
                    continue
                if any(docs[d][k : k + width] == window for d in docs for k in range(len(docs[d])) if (d, k) < (doc, at)):
                    doomed |= set(range(at, at + width))
        found, runs = got.get(doc, (set(), []))
        assert found == doomed
        for start, length, source, line in runs:  # stands as a whole at an earlier place, and in no longer run
            assert docs[source][line : line + length] == lines[start : start + length] and (source, line) < (doc, start)
            assert not any(s <= start and start + length <= s + n for s, n, *_ in runs if (s, n) != (start, length))
        assert {k for s, n, *_ in runs for k in range(s, s + n)} == doomed
