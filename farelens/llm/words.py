"""Words of Arrow text columns as 64-bit hashes, computed on whole byte buffers.

A word's hash is a polynomial over random byte values modulo 2**64, read from one running sum per block; it is
then mixed with the word's length. Equal words have equal hashes in every task and run. Two different words
share a hash with a chance of about 2**-64, which all users of these hashes accept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BLOCK_BYTES = 2_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _class(excluded: list[tuple[int, int]]) -> np.ndarray:
    inside = np.ones(256, bool)
    for a, b in excluded:
        inside[a : b + 1] = False
    return inside


#: Bytes that belong to a word: everything but white space; letters, digits and everything beyond ASCII.
NOT_SPACE = _class([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one-to-one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Block:
    """Words of some rows: ``data`` bytes, ``starts`` and ``ends`` of words, ``bounds`` of rows in words."""

    first_row: int
    n_rows: int
    data: np.ndarray
    row_bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes from each start to its end."""
        inverse = powers(len(self.data) + 1)[1]
        h = (self.sums[ends] - self.sums[starts]) * inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends)


def text_blocks(texts: pa.Array, inside: np.ndarray, lower: bool = True, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of whole rows of about ``limit`` bytes; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield _block(raw[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], row, inside, lower)
        row = last


def _block(data: np.ndarray, row_bytes: np.ndarray, row: int, inside: np.ndarray, lower: bool) -> Block:
    if lower:
        data = LOWER[data]
    size = len(data)
    word = np.zeros(size + 1, bool)
    word[:size] = inside[data]
    before = np.zeros(size + 1, bool)
    before[1:] = word[:-1]
    before[row_bytes] = False  # a row begins here
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(size + 1, bool)
    after[:-1] = word[1:]
    after[row_bytes[1:] - 1] = False  # a row ends here; for empty leading rows this sets the spare last cell
    ends = np.flatnonzero(word & ~after) + 1
    forward = powers(size + 1)[0]
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * forward[:size], dtype=np.uint64, out=sums[1:])
    bounds = np.searchsorted(starts, row_bytes)
    return Block(row, len(row_bytes) - 1, data, row_bytes, starts, ends, bounds, sums)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values; as many as there are full runs."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = total * _U(_BASE) + hashes[k : k + len(total)]
    return mix(total + _U(n))


def combine(hashes: np.ndarray) -> np.uint64:
    """One hash of a sequence of hashes and its length."""
    forward = powers(len(hashes) + 1)[0]
    return mix(np.array([(hashes * forward[: len(hashes)]).sum(dtype=np.uint64) + _U(len(hashes))], np.uint64))[0]


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Hand texts to Python a few at a time, so that a batch of very long ones fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups of equal ``key`` from a stream sorted by it, however batches cut them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if keys[-1] == keys[0] and (not held or held[-1].column(key)[-1].as_py() == keys[0]):
            held.append(batch)
            continue
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[-1] != keys[0] else 0
        done = [*held, batch.slice(0, cut)] if cut else held
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
