"""Best-fit packing of token sequences under several capacities.

A piece needs tokens, one place and attention cost (the square of its length); a sequence has a capacity of each.
Pieces of one length are alike in all of these, so the plan is made for lengths: from the longest on, every piece
goes to the sequence with room for it whose remaining capacities fit best, by the weighted dot product of demand and
remainder or by the norm of what would remain. Sequences with equal remainders are alike too, so the plan works on
ranges of sequences, not on single ones, and its size follows from the capacities, not from the number of pieces.
Spark then numbers the pieces of each length and looks their numbers up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelens.llm.words import NOT_SPACE, small_batches, text_blocks
from farelens.session import materialize, spread

TOKENS = 1024
END = 2
VOCABULARY = "byte_bpe_50k"
#: Ids of stretches of text that a task remembers (4 bytes each).
REMEMBERED = 8_000_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds; the attention cost of a piece is the square of its length."""

    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS * TOKENS


def pack_lengths(counts: dict[int, int], capacity: Capacity, rule: str = "dot") -> list[tuple[int, int, int, int, int]]:
    """Plan rows (length, first number, pieces, first sequence, offset): piece k of a row is in sequence first + k.

    ``rule`` is "dot" (largest weighted dot product of demand and remainder relative to the capacities, tokens weighted
    by how full the sequence gets) or "norm" (smallest norm of the remainder). No capacity is ever exceeded. Empty
    pieces (length 0) share sequences as far as the number of documents allows.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    free: dict[tuple[int, int, int], list[list[int]]] = {}  # remainder: ranges of sequences [first, number]
    plan, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0
        need = np.array([length, 1, length * length], float)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of a sequence")
        while left:
            states = np.array(list(free), float).reshape(-1, 3)
            fits = (states >= need).all(axis=1)
            if fits.any():
                state = tuple(int(x) for x in states[_best(states, fits, need, full, rule)])
                ranges = free[state]
                first, n = ranges.pop()
                if not ranges:
                    del free[state]
            else:
                state = (capacity.tokens, capacity.documents, capacity.attention)
                # As few new sequences as pieces of this length need if they are stacked.
                stacked = min(capacity.documents, capacity.tokens // max(length, 1), capacity.attention // max(length * length, 1))
                first, n = sequences, -(-left // max(1, stacked))
                sequences += n
            used = min(left, n)
            if used < n:
                free.setdefault(state, []).append([first + used, n - used])
            plan.append((length, number, used, first, capacity.tokens - state[0]))
            rest = (state[0] - length, state[1] - 1, state[2] - length * length)
            if rest[1]:
                free.setdefault(rest, []).append([first, used])
            number, left = number + used, left - used
    return plan


def _best(states: np.ndarray, fits: np.ndarray, need: np.ndarray, full: np.ndarray, rule: str) -> int:
    """The state that fits best; of equal ones that with the least tokens left, then the first."""
    rest = (states - need) / full
    if rule == "norm":
        value = -(rest**2).sum(axis=1)
    else:
        # A scarce capacity weighs more: the weight is one over what is left of it.
        weights = 1 / np.maximum(states / full, 1e-9)
        value = (weights * need / full).sum(axis=1)
    value = np.where(fits, value, -np.inf)
    top = np.flatnonzero(value >= value.max() - 1e-12)
    return int(top[np.argmin(states[top, 0])])


class Encoder:
    """Token ids of whole texts, remembering those of stretches between single spaces.

    A space between two characters that are not white space always begins a token of its own, so that the ids of a
    text are those of its stretches, one after another. Unknown stretches are encoded together, joined the same way.
    A text that holds the text of a special token goes to the tokenizer as a whole.
    """

    SLOT_BITS = 20

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb"))}
        self.fast = tiktoken.Encoding("stretches", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.special = b"<|endoftext|>"
        self.token_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for text, k in ranks.items():
            self.token_bytes[k] = len(text)
        self._forget()

    def _forget(self) -> None:
        # One slot for each hash prefix; a later stretch takes the place of an earlier one.
        self.key = np.zeros(1 << self.SLOT_BITS, np.uint64)
        self.first = np.zeros(1 << self.SLOT_BITS, np.int64)
        self.count = np.zeros(1 << self.SLOT_BITS, np.int64)
        self.pool, self.used = np.zeros(REMEMBERED, np.uint32), 0

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for block in text_blocks(texts, NOT_SPACE, lower=False, limit=1_000_000):
            yield from self._block(block)

    def _block(self, block) -> Iterator[np.ndarray]:
        data, rows = block.data, block.row_bytes
        heads = rows[:-1][np.diff(rows) > 0]
        starts = np.sort(np.concatenate([self._cuts(data), heads]), kind="stable")
        starts = starts[np.diff(starts, prepend=-1) > 0]
        ends = np.append(starts[1:], len(data))
        if self.used + len(data) > REMEMBERED:
            self._forget()
            if len(data) > REMEMBERED:
                self.pool = np.zeros(len(data) + 1, np.uint32)
        hashes = block.span_hashes(starts, ends) | np.uint64(1)
        slot = (hashes >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        first, count = self.first[slot], self.count[slot]
        miss = np.flatnonzero(self.key[slot] != hashes)
        if len(miss):
            distinct, at, which = np.unique(hashes[miss], return_index=True, return_inverse=True)
            new_first, new_count = self._learn(data, starts, ends, miss[at], heads)
            into = (distinct >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
            self.key[into], self.first[into], self.count[into] = distinct, new_first, new_count
            first[miss], count[miss] = new_first[which], new_count[which]
        out_first = np.cumsum(count) - count
        source = np.arange(count.sum()) + np.repeat(first - out_first, count)
        stream = self.pool[source]
        bounds = np.append(out_first, len(stream))[np.searchsorted(starts, rows)]
        raw = data.tobytes()
        special = self.special in raw
        for r in range(block.n_rows):
            text = raw[rows[r] : rows[r + 1]] if special else b""
            if self.special in text:
                yield np.array(self.exact.encode(text.decode("utf-8"), add_special_tokens=False).ids, np.uint32)
            else:
                yield stream[bounds[r] : bounds[r + 1]]

    def _learn(self, data, starts, ends, chosen, heads) -> tuple[np.ndarray, np.ndarray]:
        """Encode stretches into the pool; where each begins there and its number of ids."""
        # Those that begin and end at a single space can be joined; the first and last of a row cannot.
        inner = ~np.isin(starts[chosen], heads) & ~np.isin(ends[chosen], np.append(heads, len(data)))
        first, count = np.zeros(len(chosen), np.int64), np.zeros(len(chosen), np.int64)
        joined, k = [], chosen[inner]
        if len(k):
            sizes = ends[k] - starts[k]
            begin = np.cumsum(sizes) - sizes
            text = data[np.arange(sizes.sum()) + np.repeat(starts[k] - begin, sizes)].tobytes().decode("utf-8")
            ids = np.array(self.fast.encode_ordinary(text), np.uint32)
            at = np.searchsorted(np.cumsum(self.token_bytes[ids]), begin, "right")
            at[0] = 0
            first[inner] = self.used + at
            count[inner] = np.diff(np.append(at, len(ids)))
            joined.append(ids)
        place = self.used + sum(map(len, joined))
        for i in np.flatnonzero(~inner).tolist():
            ids = self.fast.encode_ordinary(data[starts[chosen[i]] : ends[chosen[i]]].tobytes().decode("utf-8"))
            first[i], count[i] = place, len(ids)
            place += len(ids)
            joined.append(np.array(ids, np.uint32))
        self.pool[self.used : place] = np.concatenate(joined)
        self.used = place
        return first, count

    @staticmethod
    def _cuts(data: np.ndarray) -> np.ndarray:
        """Places of single spaces between characters that are surely not white space, ASCII or other."""
        at = np.flatnonzero(data[1:-1] == 0x20) + 1 if len(data) > 2 else np.zeros(0, np.int64)
        before, after = data[at - 1], data[at + 1]
        before2 = data[np.maximum(at - 2, 0)]
        # Unicode white space begins with the bytes C2, E1, E2 or E3; its last two are as tested here.
        wide = ((before2 == 0xC2) & ((before == 0x85) | (before == 0xA0))) | (((before2 == 0x9A) | (before2 == 0x80) | (before2 == 0x81)) & (before >= 0x80))
        plain_before = NOT_SPACE[before] & ~wide
        plain_after = NOT_SPACE[after] & ~np.isin(after, np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8))
        return at[plain_before & plain_after & (before >= 0x21)]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, number bigint"


def _pieces(vocabulary: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, numbers = Encoder(vocabulary), TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            names = batch.column("doc_id")
            rows = []
            for row, ids in enumerate(encoder.encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(END)).astype("<u4")
                first = len(ids) % limit or limit
                cuts = [0, *range(first, len(ids) + 1, limit)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((names[row].as_py(), k, a, b - a, zlib.crc32(ids[a:b].tobytes()), task, numbers[b - a]))
                    numbers[b - a] += 1
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_int, c)), t) for c, t in zip(columns, kinds, strict=True)], PIECE_NAMES)

    return run


def _int(x):
    return None if x is None else int(x)


PIECE_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def token_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKENS) -> DataFrame:
    """Pieces of at most ``limit`` ids of every row of ``docs``, stored with their number among the task's pieces of that length.

    A null text is empty: it has one piece, the end mark. Of a longer document the first piece takes what the whole
    pieces leave over.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return materialize(spread(docs, docs).mapInArrow(_pieces(vocabulary, limit), PIECES), "pieces")


def place_pieces(pieces: DataFrame, capacity: Capacity = Capacity(), rule: str = "dot") -> DataFrame:
    """``pieces`` (stored; with task, number and length) with ``sequence_id`` and ``offset``."""
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = materialize(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    plan = np.array(pack_lengths(counts, capacity, rule), np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # The size of the plan follows from the capacities; so does that of the broadcast.
    shared = pieces.sparkSession.sparkContext.broadcast((plan, plan[:, 0] << 40 | plan[:, 1]))
    numbered = pieces.join(by_task.select("task", "length", "before"), ["task", "length"])
    numbered = numbered.withColumn("number", F.col("number") + F.col("before")).drop("before", "task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys = shared.value
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            k = np.searchsorted(keys, length << 40 | number, "right") - 1
            placed = [pa.array(rows[k, 3] + number - rows[k, 1]), pa.array(rows[k, 4])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *placed], [*batch.schema.names, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema)
    return numbered.mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint").drop("number")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str = "") -> DataFrame:
    """Pieces of all documents with their places; also the last stage of the pipeline.

    The number of documents and the attention cost of a sequence are bounded by what its tokens allow, so that the
    number of sequences is as small as the tokens permit. An empty table has no pieces. Extra columns are ignored.
    """
    return place_pieces(token_pieces(docs))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_packing": op2_packing}
SQL: dict[str, str] = {}
