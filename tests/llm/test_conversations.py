"""Parallel Viterbi against all edits in order of cost, long conversations in small chunks, odd rows, the query and its SQL."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from farelens.llm import conversations as module
from tests.compare import compare, connect

SPACE = " \t\n\x0b\x0c\r"
FIELDS = "conv_id bigint, turn bigint, role string, text string, audit string, cost string"


def damaged(rows):
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield conv_id, turn, "user" if kind == 4 else role, text


def cheapest(messages):
    """Least (cost, edits) by a search over single edits in that order; messages are (role, text, gone, truncated)."""
    queue, seen = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, at, state, out = heapq.heappop(queue)
        if at == len(messages) and state in (0, 3):
            return cost, audit, out
        if (at, state) in seen:
            continue
        seen.add((at, state))
        wanted, into = ("assistant", 3) if state == 2 else ("user", 2)
        heapq.heappush(queue, (cost + 2, audit + "I", at, into, (*out, f"{wanted}:")))
        if at == len(messages):
            continue
        role, text, gone, cut = messages[at]
        heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state, out))
        if not gone:
            heapq.heappush(queue, (cost + 2 + cut, audit + "R", at + 1, into, (*out, f"{wanted}:{text}")))
            kept = {"s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(role[:1])
            if kept:
                heapq.heappush(queue, (cost + cut, audit + "K", at + 1, kept, (*out, f"{role}:{text}")))


def by_hand(rows):
    ids, after = {r[0] for r in rows}, list(damaged(rows))
    for conv_id in ids:
        mine = [r[1:] for r in after if r[0] == conv_id]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, messages, counts = set(), [], [0, 0, 0]
        for _, role, text in mine:
            bare = text.strip(SPACE)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            messages.append((role, text, fault in (0, 1), fault == 2))
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:], strict=False))
        cost, audit, out = cheapest(messages)
        yield (repr(conv_id), gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def check(spark, rows, chunk):
    df = spark.createDataFrame([(*r, "a", "c") for r in rows], FIELDS).repartition(4)
    got = [(repr(r[0]), *r[1:]) for r in module.repair(df, chunk).collect()]
    assert sorted(got) == sorted(by_hand(rows))


def some_rows(conversations, longest, seed, roles=("user", "assistant", "system", "uber", "", None)):
    draw = random.Random(seed)
    texts = ["Yes.", "no", "What?", "", " \n", None, "Go on!  ", "end. \t", "x" * 5000, "é…"]
    for c in range(conversations):
        usual = draw.random() < 0.5
        for t in range(draw.randint(1, longest)):
            role = ("user", "assistant")[t % 2] if usual and draw.random() < 0.8 else draw.choice(roles)
            yield (c if c else None, draw.choice([t, t, t, 3 * t, None]), role, draw.choice(texts) if draw.random() < 0.6 else f"text {t % 7}.")


@pytest.mark.parametrize("chunk", [1, 3, module.CHUNK])
def test_random_conversations(spark, chunk):
    check(spark, list(some_rows(25, 12, chunk)), chunk)


def test_long_conversations_in_small_chunks(spark):
    """Many passes: chunks that settle, and chunks of unknown roles, which never do."""
    rows = list(some_rows(2, 160, 9)) + [(7, t, "other", f"message {t}.") for t in range(120)]
    check(spark, rows, 2)


def test_repeated_messages_of_one_turn(spark):
    rows = [(1, None, "user", "again.")] * 60 + [(2, 5, r, t) for r in ("user", "assistant") for t in ("a.", "b.")] * 3 + [(3, 0, "system", "only")]
    check(spark, rows, 4)


def test_conversation_of_which_nothing_is_left(spark):
    name = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = module.repair(spark.createDataFrame([(name, 0, "user", "Hello.")], "conv_id bigint, turn bigint, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(name, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table(spark):
    assert module.repair(spark.createDataFrame([], FIELDS)).count() == 0


def test_settled():
    vector = np.array([3, 0, 5, 2])
    parallel = np.stack([vector + c for c in (0, 4, 1, 9)], axis=1)
    assert module.settled(parallel) and module.settled(np.where(np.arange(4) == 2, module.INFINITE, parallel))
    assert not module.settled(parallel + np.eye(4, dtype=int))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert compare(spark, connect(folder), "op12", module.op12_conversations, module.SQL["op12_conversations"], folder) is None
