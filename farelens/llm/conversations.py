"""Repair of conversation structure by a parallel Viterbi over chunks of a conversation.

Each message is kept, given another role, deleted, or preceded by empty messages, so that the roles follow one pattern
at the least cost. The automaton of the pattern has four states, so a message is a 4 x 4 matrix over (min, +), and the
cheapest way on from each state is a vector computed backward. Conversations of any length are cut into chunks: every
chunk starts from speculative cost vectors, one for each state. Where what comes out of a chunk differs only by
constants, it no longer depends on what follows; other chunks are run on into the ones that follow in fix-up passes,
each over twice the distance, until that is so or the conversation ends. Then every chunk gets the true costs at its end and
traces the cheapest edits forward, the ASCII-least at ties; the state it is entered in is found the same way.

Deleted messages (blank ones and repeats) leave all costs in proportion and take no part in the chunks' costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import broadcast_if_bounded, materialize

#: Messages of a chunk, at most.
CHUNK = 1024
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
INFINITE = 10**9
#: The cheapest ways on from two states differ by less than this, so ends that cost more than another one by so much are
#: never taken.
_FAR = 1000
#: Cells (chunks times the longest one's messages) that a task works on at once.
_CELLS = 500_000

#: States: nothing yet, after a system message, after a user, after an assistant message. The message that may be inserted
#: in each (all but one a user's), and the state after it.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])

#: Symbols of messages: role initial s, u, a or other, plus 4 if truncated; MUST_GO for blank ones and repeats.
MUST_GO = 8
OPS = ["D", "K", "R"]
LEGAL = ("su", "ua", "au")
BLANK = r"^[ \t-\r]*\z"
CUT_SHORT = r"[^.!? \t-\r][ \t-\r]*\z"


def _kept_state(symbol: int) -> list[int]:
    """State after keeping a message, from each state; -1 where its role may not stand."""
    role = symbol % 4 if symbol < MUST_GO else 3
    return [[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1] * 4][role]


KEPT = np.array([_kept_state(k) for k in range(9)])
EXTRA = np.array([TRUNCATED * (k // 4) for k in range(8)] + [0])


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of matrices over (min, +); leading axes are those of many products."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), INFINITE)


def _matrices() -> np.ndarray:
    """Cost from each state before a message, insertions included, to each state after it, by symbol."""
    insert = np.full((4, 4), INFINITE)
    np.fill_diagonal(insert, 0)
    insert[np.arange(4), NEXT] = INSERT
    insert = min_plus(insert, insert)
    out = np.full((9, 4, 4), INFINITE)
    for symbol in range(9):
        for state in range(4):
            out[symbol, state, state] = DELETE
            if symbol != MUST_GO:
                into = NEXT[state]
                out[symbol, state, into] = min(out[symbol, state, into], REROLE + EXTRA[symbol])
                if KEPT[symbol, state] >= 0:
                    out[symbol, state, KEPT[symbol, state]] = EXTRA[symbol]
    return min_plus(insert, out)


MATRICES = _matrices()
#: Costs after the last message: the pattern may end before anything or after an assistant's message.
END = np.array([0, 2 * INSERT, INSERT, 0])


# ---- what one task does with the chunks of a batch: all of them at once, message by message from the end


def _stack(symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks by falling length as rows of a matrix that ends at the last column: their order, lengths and symbols."""
    lengths = np.array([len(s) for s in symbols], np.int64)
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    out = np.full((len(symbols), longest), MUST_GO, np.int64)
    for row, k in enumerate(order):
        if lengths[k]:
            out[row, longest - lengths[k] :] = symbols[k]
    return order, lengths[order], out


def backward(symbols: list[np.ndarray], after: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """Costs before each chunk's first message from those ``after`` its last one (chunks x 4 x vectors); with ``keep``
    also those before every message, from the last one back, of the chunks that are long enough, longest first."""
    order, lengths, rows = _stack(symbols)
    costs = after[order].copy()
    kept = [costs.copy()] if keep else []
    for back in range(rows.shape[1]):
        n = int(np.searchsorted(-lengths, -back, "left"))  # chunks of more than ``back`` messages
        costs[:n] = min_plus(MATRICES[rows[:n, -1 - back]], costs[:n])
        if keep:
            kept.append(costs[:n].copy())
    out = np.empty_like(costs)
    out[order] = costs
    return out, kept


def trace(symbols: list[np.ndarray], after: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Exit state of each chunk for each state it is entered in, and the edits: entry states x messages, as the number
    of insertions before the message times 3, plus 0 for D, 1 for K, 2 for R."""
    order, lengths, rows = _stack(symbols)
    _, kept = backward(symbols, after[:, :, None], keep=True)
    longest = rows.shape[1]
    state = np.tile(np.arange(4), (len(symbols), 1))
    edits = np.zeros((len(symbols), 4, longest), np.int8)
    for back in range(longest - 1, -1, -1):
        n = int(np.searchsorted(-lengths, -back, "left"))
        before, beyond = kept[back + 1][:n, :, 0], kept[back][:n, :, 0]
        symbol = rows[:n, -1 - back][:, None]
        here = state[:n]
        chosen, inserted = np.full(here.shape, -1), np.zeros(here.shape, np.int64)
        for _ in range(3):
            cost = np.take_along_axis(before, here, 1)
            into, kept_into = NEXT[here], KEPT[symbol, here]
            delete = DELETE + np.take_along_axis(beyond, here, 1) == cost
            insert = INSERT + np.take_along_axis(before, into, 1) == cost
            extra = EXTRA[symbol]
            stay = (kept_into >= 0) & (symbol != MUST_GO) & (extra + np.take_along_axis(beyond, np.maximum(kept_into, 0), 1) == cost)
            open_ = chosen < 0
            # In ASCII order: D, I, K, R.
            insert &= open_ & ~delete
            edit = np.where(delete, 0, np.where(stay, 1, 2))
            done = open_ & ~insert
            chosen = np.where(done, edit, chosen)
            moved = np.where(edit == 0, here, np.where(edit == 1, kept_into, into))
            here = np.where(insert, into, np.where(done, moved, here))
            inserted += insert
        edits[:n, :, longest - 1 - back] = inserted * 3 + chosen
        state[:n] = here
    exits, out = np.empty_like(state), [None] * len(symbols)
    for row, k in enumerate(order):
        exits[k] = state[row]
        out[k] = edits[row, :, longest - lengths[row] :]
    return exits, out


# ---- the same over all chunks, in Spark


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with every null of a text column as one space and one of five
    kinds of damage to about a quarter of the rows, as the checksum of ``conv_id:turn`` (a null there also is one space)
    tells."""
    conv_id, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    name = F.concat(conv_id, F.lit(":"), turn)
    kind = F.col("kind")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("kind")).filter("kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def ordered(messages: DataFrame) -> DataFrame:
    """``messages`` stored in the order of conversations and turns, ``at`` being a message's place in this order.

    Nulls come first; messages of one turn are ordered by role, then by the digest of the text. The ranges also hold the
    task a message comes from, so that even equal messages of one turn are dealt to many tasks.
    """
    keyed = messages.withColumns({"digest": F.unhex(F.sha2(F.col("text"), 256)), "source_task": F.spark_partition_id()})
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "source_task")]
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("source_task")
    return materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "conversation-order")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def with_faults(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Ordered messages (without their texts) with ``fault`` (1 blank, 2 repeat, 3 truncated, else 0), ``symbol`` and ``block``.

    A repeat has the role and text of an earlier message of its conversation. Only roles and texts that occur more than
    once there are looked up.
    """
    blank = F.col("text").rlike(BLANK)
    slim = rows.select("conv_id", "at", "role", "digest", blank.alias("blank"), F.col("text").rlike(CUT_SHORT).alias("cut"))
    repeated = slim.groupBy("conv_id", "role", "digest").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    repeated = repeated.filter("n > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
    repeated = broadcast_if_bounded(materialize(repeated, "repeated-messages"))
    found = slim.join(repeated, _same("conv_id", "_c") & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("first"), 2).when(F.col("cut"), 3).otherwise(0)
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin(1, 2), MUST_GO).when(F.col("fault") == 3, role + 4).otherwise(role)
    # Places of one task lie below 2**33; a block never spans two tasks.
    task = F.shiftright("at", 33)
    block = F.shiftleft(task, 33) + F.floor((F.col("at") - F.shiftleft(task, 33)) / chunk)
    found = found.withColumn("fault", fault).withColumns({"symbol": symbol, "block": block})
    return found.select("conv_id", "at", "block", "fault", F.col("symbol").cast("int").alias("symbol"))


def chunks_of(faults: DataFrame) -> DataFrame:
    """One row a chunk (``conv_id``, ``block``): its messages' symbols and faults in order, and the block of the chunk after it."""
    listed = F.sort_array(F.collect_list(F.struct("at", "symbol", "fault")))  # at most as many as a chunk has
    grouped = faults.groupBy("conv_id", "block").agg(listed.alias("m"))
    grouped = grouped.select("conv_id", "block", F.col("m.at")[0].alias("at"), F.col("m.symbol").alias("symbols"), F.col("m.fault").alias("faults"))
    grouped = materialize(grouped, "conversation-chunks")
    # A conversation's messages are contiguous, so its next chunk is the next block of the task or the first of the next task.
    ends = grouped.groupBy(F.shiftright("block", 33).alias("task")).agg(F.min("block").alias("low"), F.max("block").alias("high"))
    ends = sorted(tuple(r) for r in ends.collect())  # one row a task
    follow = [(high, low) for (_, _, high), (_, low, _) in zip(ends, ends[1:], strict=False)]
    jumps = grouped.sparkSession.createDataFrame(follow, "last bigint, follower bigint")
    linked = grouped.join(F.broadcast(jumps), F.col("block") == F.col("last"), "left")
    linked = linked.withColumn("next", F.coalesce("follower", F.col("block") + 1)).drop("last", "follower")
    # Only chunks that have a follower in their own conversation keep the link.
    heads = grouped.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"))
    linked = linked.join(heads, _same("conv_id", "_c") & (F.col("next") == F.col("_b")), "left")
    return materialize(linked.withColumn("next", F.col("_b")).drop("_c", "_b"), "conversation-chunks")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of a batch of chunks that a task can work on at once, with the chunks' symbols."""
    symbols = batch.column("symbols")
    values, bounds = symbols.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(np.asarray(symbols.value_lengths()))])
    first = 0
    while first < batch.num_rows:
        longest = np.maximum.accumulate(np.diff(bounds[first:]))
        n = max(1, int(np.searchsorted(longest * np.arange(1, len(longest) + 1), _CELLS, "right")))
        yield batch.slice(first, n), [values[a:b] for a, b in zip(bounds[first : first + n], bounds[first + 1 : first + n + 1], strict=True)]
        first += n


def _pruned(costs: np.ndarray) -> np.ndarray:
    """Matrices less their smallest cost, without ends that are far more expensive than another."""
    low = costs.min(axis=-1, keepdims=True)
    return np.where(costs - low > _FAR, INFINITE, costs - low.min(axis=-2, keepdims=True))


LINK = "conv_id bigint, block bigint, next bigint, "


def _speculative(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start = np.full((4, 4), INFINITE)
    np.fill_diagonal(start, 0)
    for batch in batches:
        for part, symbols in _slices(batch):
            costs, _ = backward(symbols, np.tile(start, (part.num_rows, 1, 1)))
            costs = pa.array(_pruned(costs).reshape(part.num_rows, 16).tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("conv_id", "block", "next")], costs], ["conv_id", "block", "next", "costs"])


def settled(costs: np.ndarray) -> np.ndarray:
    """Whether all speculative vectors (columns of 4 x 4) of a chunk differ only by constants."""
    live = np.where(costs.min(axis=-2, keepdims=True) < INFINITE // 2, costs - costs.min(axis=-2, keepdims=True), -1)
    same = [[(live[..., j] == live[..., k]).all(-1) | (live[..., j] == -1).all(-1) | (live[..., k] == -1).all(-1) for k in range(4)] for j in range(4)]
    return np.all(same, axis=(0, 1))


def _run_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put the vectors of a chunk together with those of the chunk it is linked with; ``next`` is null once they are final."""
    for batch in batches:
        n = batch.num_rows
        costs = np.array(batch.column("costs").to_pylist(), np.int64).reshape(n, 4, 4)
        further = batch.column("further").to_pylist()
        steps, vectors = batch.column("next_next").to_pylist(), costs.copy()
        has = np.array([f is not None for f in further], bool)
        if has.any():
            vectors[has] = min_plus(costs[has], np.array([f for f in further if f is not None], np.int64).reshape(-1, 4, 4))
        vectors = _pruned(vectors)
        # With the vectors of all four states in proportion, any of them is the chunk's, whatever follows.
        done = settled(vectors)
        new_next = [None if d or not h else s for d, h, s in zip(done, has, steps, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.array(new_next, pa.int64()), pa.array(vectors.reshape(n, 16).tolist(), pa.list_(pa.int64()))],
            ["conv_id", "block", "next", "costs"],
        )


def head_costs(chunks: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, ``head``: costs before the first message of each chunk that follows another, up to a constant.

    The speculative vectors of a chunk are its matrix over (min, +). Each pass multiplies it with that of the chunk it is
    linked with and takes over that one's link, so that the passes grow with the logarithm of the number of chunks that
    do not settle. A chunk without a link has settled, or has reached the end of its conversation.
    """
    several = chunks.filter(F.col("next").isNotNull()).select(F.col("conv_id").alias("_c"), F.col("next").alias("_b"))
    followers = chunks.join(several, _same("conv_id", "_c") & (F.col("block") == F.col("_b")), "left_semi")
    runs = materialize(followers.select("conv_id", "block", "next", "symbols").mapInArrow(_speculative, LINK + "costs array<bigint>"), "conversation-costs")
    while runs.filter(F.col("next").isNotNull()).limit(1).count():
        linked = runs.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("costs").alias("further"), F.col("next").alias("next_next"))
        joined = runs.join(linked, _same("conv_id", "_c") & (F.col("next") == F.col("_b")), "left").drop("_c", "_b")
        runs = materialize(joined.mapInArrow(_run_on, LINK + "costs array<bigint>"), "conversation-costs")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = np.array(batch.column("costs").to_pylist(), np.int64).reshape(batch.num_rows, 4, 4)
            head = (costs + END[None, None, :]).min(axis=2)
            head = pa.array((head - head.min(axis=1, keepdims=True)).tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), head], ["conv_id", "block", "head"])

    return runs.mapInArrow(heads, "conv_id bigint, block bigint, head array<bigint>")


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    same = ["conv_id", "block", "next", "at", "faults"]
    for batch in batches:
        for part, symbols in _slices(batch):
            after = np.array([END if h is None else h for h in part.column("head").to_pylist()], np.int64).reshape(-1, 4)
            exits, edits = trace(symbols, after)
            edits = pa.array([[row.tobytes() for row in e] for e in edits], pa.list_(pa.binary()))
            exits = pa.array(exits.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in same], exits, edits], [*same, "exits", "edits"])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry state of a chunk for each entry state of the chunk it looks back at, over twice the distance."""
    for batch in batches:
        moves = [b if x is None else [b[s] for s in x] for x, b in zip(batch.column("further").to_pylist(), batch.column("moves").to_pylist(), strict=True)]
        back = [None if len(set(m)) == 1 else k for m, k in zip(moves, batch.column("back_back").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), pa.array(back, pa.int64()), pa.array(moves, pa.list_(pa.int64()))], ["conv_id", "block", "back", "moves"]
        )


def entry_states(traced: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, ``entry``: the state in which each chunk that follows another is entered."""
    moves = traced.filter(F.col("next").isNotNull()).select("conv_id", F.col("next").alias("block"), F.col("block").alias("back"), F.col("exits").alias("moves"))
    moves = materialize(moves, "conversation-entries")
    # The first chunk of a conversation looks back at nothing: a link to it ends there, entered in the first state.
    while moves.filter(F.col("back").isNotNull()).limit(1).count():
        earlier = moves.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("moves").alias("further"), F.col("back").alias("back_back"))
        joined = moves.join(earlier, _same("conv_id", "_c") & (F.col("back") == F.col("_b")), "left").drop("_c", "_b")
        moves = materialize(joined.mapInArrow(_compose, "conv_id bigint, block bigint, back bigint, moves array<bigint>"), "conversation-entries")
    return moves.select("conv_id", "block", F.col("moves")[START].alias("entry"))


def cheapest_edits(messages: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The ordered messages and one row a chunk: ``at`` of its first message, its ``faults``, ``edits`` (one byte a message: insertions before it
    times 3, plus 0 for D, 1 for K, 2 for R) and whether it is the ``last`` of its conversation."""
    rows = ordered(messages.withColumn("conv_id", F.col("conv_id").cast("bigint")))
    chunks = chunks_of(with_faults(rows, chunk))
    heads = head_costs(chunks).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "head")
    joined = chunks.join(heads, _same("conv_id", "_c") & (F.col("next") == F.col("_b")), "left").drop("_c", "_b")
    schema = LINK + "at bigint, faults array<int>, exits array<bigint>, edits array<binary>"
    traced = materialize(joined.mapInArrow(_traced, schema), "conversation-traces")
    entries = entry_states(traced).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "entry")
    found = traced.join(entries, _same("conv_id", "_c") & (F.col("block") == F.col("_b")), "left")
    edits = F.col("edits")[F.coalesce(F.col("entry"), F.lit(START)).cast("int")].alias("edits")
    return rows, found.select("conv_id", "at", "faults", edits, F.col("next").isNull().alias("last"))


class _Report:
    """What is reported of one conversation, message after message."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.audit, self.digest = conv_id, START, [], hashlib.sha256()
        self.low = self.high = self.turn = self.initial = None
        self.turns, self.faults, self.illegal, self.cost, self.written = 0, [0, 0, 0, 0], 0, 0, 0

    def _write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written += 1

    def insert(self, times: int) -> None:
        for _ in range(times):
            self.state = NEXT[self.state]
            self.audit.append("I")
            self.cost += INSERT
            self._write("user" if self.state == USER else "assistant", "")

    def message(self, turn, role: str, text: str, fault: int, edit: int) -> None:
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn, self.turns = turn if self.low is None else self.low, turn, turn, self.turns + 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        self.faults[fault] += 1
        self.insert(edit // 3)
        op = OPS[edit % 3]
        self.audit.append(op)
        self.cost += DELETE if op == "D" else (REROLE if op == "R" else 0) + (TRUNCATED if fault == 3 else 0)
        if op == "R":
            self.state = NEXT[self.state]
            self._write("user" if self.state == USER else "assistant", text)
        elif op == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial]
            self._write(role, text)

    def row(self) -> tuple:
        self.insert({USER: 1, SYSTEM: 2}.get(int(self.state), 0))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, min(gaps, 2**63 - 1), *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations, sorted: that of the conversation, then each chunk's followed by its messages."""
    names = [f.split()[0] for f in REPORT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    current, done, edits, faults, k = None, [], b"", [], 0
    for batch in batches:
        for conv_id, kind, turn, role, text, more_edits, more_faults in zip(*[batch.column(c).to_pylist() for c in ROW], strict=True):
            if kind == 0:
                if current:
                    done.append(current.row())
                current = _Report(conv_id)
            elif kind == 1:
                edits, faults, k = more_edits, more_faults, 0
            else:
                current.message(turn, role, text, faults[k], edits[k])
                k += 1
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
            done = []
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(current.row(), kinds, strict=True)], names)


ROW = ["conv_id", "kind", "turn", "role", "text", "edits", "faults"]


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Damage ``conversations`` (conv_id, turn, role, text) and report the cheapest repair of every conversation.

    Null roles and texts are one space, and so is a null conv_id or turn in the name that the damage goes by; a null
    conv_id is a conversation of its own. Repeated rows are repeated messages. Messages of one turn are ordered by role,
    then by the SHA-256 of the text. A conversation of no rows after damage has zeros, an empty audit and the digest of
    nothing. Extra columns are ignored; an empty table gives no rows. ``gaps`` beyond the range of long are its largest
    value.

    The report of a conversation is one digest and one string over all of it, so the task that writes these reads its
    messages one after another; it holds one batch of them and the edits of one chunk.
    """
    rows, chunks = cheapest_edits(damage(conversations), chunk)
    empty = {"turn": "bigint", "role": "string", "text": "string", "edits": "binary", "faults": "array<int>"}
    nothing = lambda *names: [F.lit(None).cast(empty[n]).alias(n) for n in names]
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    parts = [
        ids.select("conv_id", F.lit(-1).cast("bigint").alias("at"), F.lit(0).alias("kind"), *nothing("turn", "role", "text", "edits", "faults")),
        chunks.select("conv_id", "at", F.lit(1).alias("kind"), *nothing("turn", "role", "text"), "edits", "faults"),
        rows.select("conv_id", "at", F.lit(2).alias("kind"), F.col("turn").cast("bigint").alias("turn"), "role", "text", *nothing("edits", "faults")),
    ]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = merged.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at", "kind")
    return merged.select(*ROW).mapInArrow(_reports, REPORT)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _more(path: str, cost: str, edit: str) -> str:
    """SQL of a path (nine digits of cost, then edits) with one more edit."""
    return f"printf('%09d', cast(left({path}, 9) as bigint) + {cost}) || substr({path}, 10) || '{edit}'"


def _statement() -> str:
    """SQL that carries the least (cost, edits) to each state from message to message; strings of both compare as such."""
    some = lambda *options: f"least({', '.join(options)})"
    when = lambda test, value: f"case when {test} then {value} end"
    inserted2 = some("x2", *[_more(f"x{k}", str(INSERT), "I") for k in (0, 1, 3)])
    inserted3 = some("x3", _more("y2", str(INSERT), "I"))
    drop = [_more(f"y{k}", str(DELETE), "D") for k in range(4)]
    keep = {k: when(f"not gone and initial = '{c}'", "{}") for k, c in enumerate("sua")}
    kept = lambda c, k: keep[c].format(_more(f"y{k}", "extra", "K"))
    given = lambda k: when("not gone", _more(f"y{k}", f"{REROLE} + extra", "R"))
    states = [
        drop[0],
        some(drop[1], kept(0, 0)),
        some(drop[2], *[kept(1, k) for k in (0, 1, 3)], *[given(k) for k in (0, 1, 3)]),
        some(drop[3], kept(2, 2), given(2)),
    ]
    return f"""with recursive crc_table as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crcs),
named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name from conversations),
summed as (
  select conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda ch: cast(ascii(ch) as bigint))),
    lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)]))) % 20 as kind from named, crc_table),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from summed where kind <> 0),
placed as (
  select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from damaged),
marked as (
  select *, left(role, 1) as initial, not regexp_matches(text, '[^ \\t-\\r]') as blank,
         regexp_matches(text, '[^.!? \\t-\\r][ \\t-\\r]*\\z') as cut,
         row_number() over (partition by conv_id, role, text order by i) > 1 as seen,
         lag(left(role, 1)) over (partition by conv_id order by i) as earlier from placed),
messages as materialized (
  select *, blank or seen as gone, case when cut and not seen then {TRUNCATED} else 0 end as extra from marked),
paths as (
  select conv_id, cast(0 as bigint) as i, '000000000' as x0, cast(null as varchar) as x1, cast(null as varchar) as x2, cast(null as varchar) as x3
  from (select distinct conv_id from conversations)
  union all
  select conv_id, i, {', '.join(f'{state} as x{k}' for k, state in enumerate(states))} from (
    select *, x0 as y0, x1 as y1, {inserted3} as y3 from (
      select p.conv_id, m.i, m.gone, m.initial, m.extra, x0, x1, x2, x3, {inserted2} as y2
      from paths p join messages m on m.conv_id is not distinct from p.conv_id and m.i = p.i + 1))),
ends as (
  select conv_id, {some('x0', 'y3')} as path from (
    select *, {inserted3} as y3 from (select *, {inserted2} as y2 from paths))
  qualify row_number() over (partition by conv_id order by i desc) = 1),
edits as (
  select conv_id, substr(path, 10) as audit, unnest(range(1, length(path) - 8)) as p from ends),
steps as (
  select conv_id, p, audit[p] as edit,
         sum(case when audit[p] = 'I' then 0 else 1 end) over w as i, sum(case when audit[p] = 'D' then 0 else 1 end) over w as k
  from edits window w as (partition by conv_id order by p rows unbounded preceding)),
written as (
  select s.conv_id, p, edit, k, m.role, m.text,
         max(case when k = 1 and edit = 'K' and initial = 's' then 1 else 0 end) over (partition by s.conv_id) as starts
  from steps s left join messages m on m.conv_id is not distinct from s.conv_id and m.i = s.i and edit <> 'I' where edit <> 'D'),
repaired as (
  select conv_id, string_agg(case when edit = 'K' then role when (k - starts) % 2 = 1 then 'user' else 'assistant' end
                             || ':' || case when edit = 'I' then '' else text end, chr(10) order by p) as lines
  from written group by conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
         count(*) filter (not blank and seen) as duplicate, count(*) filter (not blank and not seen and cut) as truncated,
         count(*) filter (earlier is not null and earlier || initial not in ('su', 'ua', 'au')) as illegal from messages group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, cast(left(path, 9) as bigint) as cost, substr(path, 10) as audit, sha256(coalesce(lines, '')) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id left join repaired r on r.conv_id is not distinct from e.conv_id"""


QUERIES = {"op12_conversations": op12_conversations}
SQL = {"op12_conversations": _statement()}
