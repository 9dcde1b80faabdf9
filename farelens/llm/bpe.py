"""Byte-level BPE of whole texts by merge replay over a corpus's words, and its inverse.

A word is a stretch of text that no merge crosses: what lies between two single spaces, with the space before it. The
words of the whole corpus are counted; the ones that occur most often are replayed together, once for the corpus: an
inverted index leads from the rank of a token pair to the places of that pair in all words, the ranks are taken from
the lowest on, each is applied at all of its places, and only the pairs of the merged token with its neighbours are
entered anew. The resulting table, of a bounded size, goes to all tasks. Words that are not in it are replayed the
same way, all new ones of a block of texts together, so that the ids never depend on what the table holds.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm.packing import Encoder
from farelens.llm.words import NOT_SPACE, small_batches, text_blocks
from farelens.session import materialize, spread

VOCABULARY = "byte_bpe_multi_50k"
#: Words that the corpus's table holds at most: the bound of what is broadcast (some 40 bytes a word).
TABLE_WORDS = 200_000
#: Texts longer than this many bytes are outside the table whatever their count.
TABLE_WORD_BYTES = 64
#: Words of the table replayed in one task.
REPLAYED_TOGETHER = 25_000
#: Steps of the histogram of counts for each doubling.
STEPS = 4
#: Pairs whose rank is remembered in a worker.
_PAIRS = 500_000
#: Places of one rank from which on they are merged together rather than one by one.
_MANY = 64


class Vocabulary:
    """Ranks of a byte-level vocabulary, from its file; a token's id is its rank."""

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers
        import regex

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split_pattern = public_tokenizers.PATTERN
        self.pattern = regex.compile(self.split_pattern)
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.token_bytes = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_bytes) - self.token_bytes
        self.all_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.full(1 << 16, -1, np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] << 8 | token[1]] = rank
        self.pairs: dict[int, int] = {}
        self.classes: dict[str, str] = {}

    def split(self, text: str) -> list[str]:
        """The matches of the split pattern, with the character classes of the tiktoken library.

        Its tables of Unicode are older than those of ``regex``: what is a letter or digit only in newer versions is a
        mark there. Such characters are asked of the library itself and replaced, for matching, by one of their class.
        """
        if text.isascii():
            return self.pattern.findall(text)
        recent = {c for c in set(text) if c > "\x7f" and unicodedata.category(c) == "Cn"}
        if not recent:
            return self.pattern.findall(text)
        for c in recent - self.classes.keys():
            # A letter, a digit and a mark that stand for their classes.
            self.classes[c] = "α" if self._joins("a", c) else "1" if self._joins("1", c) else "!"
        shadow = text.translate({ord(c): self.classes[c] for c in recent})
        return [text[m.start() : m.end()] for m in self.pattern.finditer(shadow)]

    def _joins(self, before: str, c: str) -> bool:
        """Whether the library keeps a character in one match with the one before it."""
        import tiktoken

        whole, ranks = (before + c).encode(), {bytes([b]): b for b in range(256)}
        for part in [c.encode()[:k] for k in range(2, len(c.encode()) + 1)] + [whole]:
            ranks[part] = len(ranks)
        return tiktoken.Encoding("probe", pat_str=self.split_pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(before + c) == [ranks[whole]]

    def pair_rank(self, left: int, right: int) -> int:
        """Rank of the token that two adjacent ones make, or -1."""
        key = left * self.size + right
        rank = self.pairs.get(key)
        if rank is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            rank = self.pairs[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return rank

    def encode_ordinary(self, text: str) -> list[int]:
        """Ids of one text; all its words are replayed together."""
        pieces = [p.encode() for p in self.split(text)]
        distinct = dict.fromkeys(pieces)
        todo = []
        for piece in distinct:
            whole = self.ranks.get(piece)
            if whole is None:
                todo.append(piece)
            else:
                distinct[piece] = [whole]
        for piece, ids in zip(todo, replay(todo, self), strict=True):
            distinct[piece] = ids
        return [i for piece in pieces for i in distinct[piece]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a run of ids."""
        sizes = self.token_bytes[ids]
        shift = self.token_starts[ids] - (np.cumsum(sizes) - sizes)
        return self.all_bytes[np.arange(sizes.sum()) + np.repeat(shift, sizes)]


def replay(words: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each word: all merges in rank order, each at all places the inverted index has for it.

    Within a word the lowest rank comes first and, of one rank, the leftmost place. A merge can make a pair of a lower
    rank than its own; then the word's other places of this rank wait until that one is done. Linear in the places
    entered: two for each merge. A rank of many places is merged at once in all words that have one of them.
    """
    if not words:
        return []
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    n = len(data)
    last = np.zeros(n, bool)
    last[ends[ends > 0] - 1] = True
    first_pairs = np.full(n, -1, np.int64)
    if n > 1:
        first_pairs[:-1] = np.where(last[:-1], -1, vocabulary.byte_pairs[data[:-1].astype(np.int64) << 8 | data[1:]])
    places = np.flatnonzero(first_pairs >= 0)
    places = places[np.argsort(first_pairs[places], kind="stable")]
    ranks, cuts = np.unique(first_pairs[places], return_index=True)
    index = {int(r): part.tolist() for r, part in zip(ranks, np.split(places, cuts[1:]), strict=True)} if len(places) else {}
    queue = sorted(index)
    # Numbers that single steps and numpy share.
    token, pair = array("q", vocabulary.of_byte[data].astype(np.int64).tobytes()), array("q", first_pairs.tobytes())
    after = array("q", np.where(last, -1, np.arange(1, n + 1)).astype(np.int64).tobytes())
    before = array("q", np.where(np.concatenate([[True], last[:-1]]), -1, np.arange(-1, n - 1)).astype(np.int64).tobytes())
    gone = bytearray(n)
    together = _Together(vocabulary, ends, index, queue, token, pair, after, before, gone)
    known, size, look_up = vocabulary.pairs, vocabulary.size, vocabulary.pair_rank
    while queue:
        rank = heapq.heappop(queue)
        held, waiting = -1, []
        at_rank = index.pop(rank)
        if len(at_rank) >= _MANY:
            at_rank = together.merge(rank, at_rank)
        at_rank.sort()
        for at in at_rank:
            if pair[at] != rank:
                continue  # one of the two has been merged with another neighbour
            if at <= held:
                waiting.append(at)
                continue
            right = after[at]
            beyond, ahead = after[right], before[at]
            token[at], gone[right], pair[right] = rank, 1, -1
            after[at] = beyond
            lower = False
            if beyond >= 0:
                before[beyond] = at
                new = known.get(rank * size + token[beyond])
                pair[at] = new = look_up(rank, token[beyond]) if new is None else new
                if new >= 0:
                    lower = new < rank
                    if new in index:
                        index[new].append(at)
                    else:
                        index[new] = [at]
                        heapq.heappush(queue, new)
            else:
                pair[at] = -1
            if ahead >= 0:
                new = known.get(token[ahead] * size + rank)
                pair[ahead] = new = look_up(token[ahead], rank) if new is None else new
                if new >= 0:
                    lower = lower or new < rank
                    if new in index:
                        index[new].append(ahead)
                    else:
                        index[new] = [ahead]
                        heapq.heappush(queue, new)
            if lower:
                held = int(ends[np.searchsorted(ends, at, "right")]) - 1
        if waiting:
            if rank in index:
                index[rank].extend(waiting)
            else:
                index[rank] = waiting
                heapq.heappush(queue, rank)
    left = np.flatnonzero(np.frombuffer(gone, np.uint8) == 0)
    ids = np.frombuffer(token, np.int64)[left].tolist()
    cuts = np.searchsorted(left, ends).tolist()
    return [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


class _Together:
    """Merges of one rank in many words at once, on the arrays of a replay."""

    def __init__(self, vocabulary: Vocabulary, ends: np.ndarray, index: dict, queue: list, token, pair, after, before, gone):
        self.look_up, self.index, self.queue = vocabulary.pair_rank, index, queue
        self.token, self.pair, self.after, self.before = (np.frombuffer(x, np.int64) for x in (token, pair, after, before))
        self.gone = np.frombuffer(gone, np.uint8)
        self.word = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))

    def merge(self, rank: int, places: list[int]) -> list[int]:
        """Merge the only place of ``rank`` in each word; the places of words that have several are left and returned."""
        at = np.array(places, np.int64)
        at = at[self.pair[at] == rank]  # others have been merged with another neighbour
        at.sort()
        word = self.word[at]
        same = word[1:] == word[:-1]
        rest = []
        if same.any():
            several = np.zeros(len(at), bool)
            several[1:] = same
            several[:-1] |= same
            rest, at = at[several].tolist(), at[~several]
        if not len(at):
            return rest
        right = self.after[at]
        beyond, ahead = self.after[right], self.before[at]
        self.token[at], self.gone[right], self.pair[right], self.pair[at] = rank, 1, -1, -1
        self.after[at] = beyond
        follows = beyond >= 0
        beyond, ahead, at = beyond[follows], ahead[ahead >= 0], at[follows]
        self.before[beyond] = at
        self._enter(at, self.token[beyond], lambda t: self.look_up(rank, t))
        self._enter(ahead, self.token[ahead], lambda t: self.look_up(t, rank))
        return rest

    def _enter(self, places: np.ndarray, neighbours: np.ndarray, rank_with) -> None:
        """Enter new pairs, whose ranks follow from the merged token's neighbours."""
        if not len(places):
            return
        order = neighbours.argsort()
        places, neighbours = places[order], neighbours[order]
        cuts = [0, *((neighbours[1:] != neighbours[:-1]).nonzero()[0] + 1).tolist(), len(places)]
        ranks = [rank_with(t) for t in neighbours[cuts[:-1]].tolist()]
        self.pair[places] = np.array(ranks, np.int64).repeat([b - a for a, b in zip(cuts, cuts[1:], strict=False)])
        places = places.tolist()
        for rank, a, b in zip(ranks, cuts, cuts[1:], strict=False):
            if rank < 0:
                continue
            if rank in self.index:
                self.index[rank].extend(places[a:b])
            else:
                self.index[rank] = places[a:b]
                heapq.heappush(self.queue, rank)


@dataclass
class WordTable:
    """Ids of words by the hash of their bytes: those of word k are ``ids[first[k] : first[k] + count[k]]``."""

    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray
    ids: np.ndarray


class WordEncoder(Encoder):
    """Encodes blocks of texts word by word; remembers the table and, in a bounded memory, the words met since."""

    def __init__(self, vocabulary: str, table: WordTable | None = None):
        self.fast = Vocabulary(vocabulary)
        self.token_bytes = self.fast.token_bytes
        self.special = b"\xff"  # never part of a text
        self.table = table
        self._forget()

    def _forget(self) -> None:
        super()._forget()
        if self.table is not None and len(self.table.keys):
            slots = (self.table.keys >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
            self.key[slots], self.first[slots], self.count[slots] = self.table.keys, self.table.first, self.table.count
            if len(self.table.ids) * 2 > len(self.pool):
                self.pool = np.zeros(len(self.table.ids) * 2, np.uint32)
            self.pool[: len(self.table.ids)] = self.table.ids
            self.used = len(self.table.ids)

    @classmethod
    def words(cls, block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of a block of texts."""
        rows = block.row_bytes
        heads = rows[:-1][np.diff(rows) > 0]
        starts = np.unique(np.concatenate([cls._cuts(block.data), heads]))
        ends = np.append(starts[1:], len(block.data))
        return starts, ends, block.span_hashes(starts, ends) | np.uint64(1)


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_blocks(batch.column("text"), NOT_SPACE, lower=False, limit=2_000_000):
            starts, ends, hashes = WordEncoder.words(block)
            if not len(starts):
                continue
            _, at, n = np.unique(hashes, return_index=True, return_counts=True)
            short = ends[at] - starts[at] <= TABLE_WORD_BYTES
            at, n = at[short], n[short]
            sizes = ends[at] - starts[at]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            data = block.data[np.arange(offsets[-1]) + np.repeat(starts[at] - offsets[:-1], sizes)]
            words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
            yield pa.RecordBatch.from_arrays([words, pa.array(n.astype(np.int64))], ["word", "n"])


def _replayed(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [w for batch in batches for w in batch.column("word").to_pylist()]  # at most REPLAYED_TOGETHER or so
        if not words:
            return
        known = Vocabulary(vocabulary)
        pieces = [[p.encode() for p in known.split(w)] for w in words]
        distinct = dict.fromkeys(p for word in pieces for p in word)
        todo = [p for p in distinct if p not in known.ranks]
        ids = {p: [known.ranks[p]] for p in distinct if p in known.ranks} | dict(zip(todo, replay(todo, known), strict=True))
        found = [[i for p in word for i in ids[p]] for word in pieces]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(found, pa.list_(pa.int32()))], ["word", "ids"])

    return run


def word_table(docs: DataFrame, vocabulary: str = VOCABULARY, most: int = TABLE_WORDS) -> WordTable:
    """Ids of the words that occur most often in all of ``docs``: those of all counts from the lowest step on at which
    they are at most ``most``. A histogram of counts finds the step, so that nothing is sorted."""
    small_batches(docs.sparkSession)
    texts = docs.select("text")
    counted = spread(texts, texts).mapInArrow(_counted_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialize(counted.filter("n > 1").withColumn("step", F.floor(F.log2("n") * STEPS)), "bpe-words")
    sizes = {r["step"]: r["count"] for r in counted.groupBy("step").count().collect()}  # a few hundred rows at most
    total, lowest = 0, None
    for step in sorted(sizes, reverse=True):
        total += sizes[step]
        if total > most:
            break
        lowest = step
    if lowest is None:
        return WordTable(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))
    total = sum(n for step, n in sizes.items() if step >= lowest)
    chosen = counted.filter(F.col("step") >= lowest).repartition(-(-total // REPLAYED_TOGETHER), F.xxhash64("word"))
    rows = chosen.select("word").mapInArrow(_replayed(vocabulary), "word string, ids array<int>").toArrow()  # at most ``most`` rows
    words, ids = rows.column("word").combine_chunks(), rows.column("ids").combine_chunks()
    keys = [block.span_hashes(block.row_bytes[:-1], block.row_bytes[1:]) for block in text_blocks(words, NOT_SPACE, lower=False)]
    count = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    return WordTable(np.concatenate(keys) | np.uint64(1), np.cumsum(count) - count, count, ids.flatten().to_numpy().astype(np.uint32))


def _binaries(parts: list[bytes | np.ndarray]) -> pa.Array:
    return pa.array([bytes(p) for p in parts], pa.binary())


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, table: Broadcast | None = None, decoded: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of the whole text of every row of ``docs``.

    With ``decoded``, the bytes that the ids stand for are added by the same task, from the ids alone. A null text is
    empty and has no ids; so has a text without characters. Repeated rows and repeated or null doc_ids stay rows of
    their own; other columns are ignored; an empty table gives no rows. The ids are the same with and without a
    ``table``, which only saves work.
    """
    small_batches(docs.sparkSession)
    names = ["doc_id", "ids", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or WordEncoder(vocabulary, table.value if table else None)
            ids = [x.astype("<u4").tobytes() for x in encoder.encode(batch.column("text"))]
            columns = [batch.column("doc_id"), _binaries(ids)]
            if decoded:
                columns.append(_binaries([encoder.fast.decode(np.frombuffer(x, "<u4")) for x in ids]))
            yield pa.RecordBatch.from_arrays(columns, names)

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return spread(docs, docs).mapInArrow(run, "doc_id bigint, ids binary" + (", decoded binary" if decoded else ""))


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``: the bytes that the ids stand for, which need not be valid UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            known = known or Vocabulary(vocabulary)
            texts = [known.decode(np.frombuffer(x.as_py() or b"", "<u4")).tobytes() for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), _binaries(texts)], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table = spark.sparkContext.broadcast(word_table(docs))
    decoded = encode(docs, table=table, decoded=True)
    n_tokens = (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens")
    return decoded.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op13_bpe": op13_bpe}
SQL: dict[str, str] = {}
