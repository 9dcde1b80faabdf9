"""N-gram Jaccard join: documents whose sets of word shingles overlap by a share, by a grouped prefix join.

The shingles of all documents get one order: rare ones first, frequent ones last. Two sets that are similar enough
share a shingle among the first few of each (the prefix). Sets with equal prefix and size form a group, and groups
rather than documents are paired by the shingles of their prefixes. A pair of groups is filtered by size and by the
number of shared prefix shingles, and only then expanded to its members, whose whole sets are compared.

Components need no link between documents that are already connected. So every group is first compared with two
pivots of each of its shingles, the smallest and the largest group there: pairs in proportion to the input, however
many near copies a shingle has. What these promising pairs connect is a block; blocks are compared inside by tiles of
their members, and groups of other blocks that may link with a member visit the tiles of the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelens.llm.components import connected, local_roots
from farelens.llm.words import NOT_SPACE, combine, mix, small_batches, text_blocks, whole_groups, windows
from farelens.session import broadcast_if_bounded, materialize, spread

#: The most frequent shingles, at most so many, go to every task (16 bytes each) to be ordered last.
MAX_FREQUENT = 500_000
FREQUENT = 8
#: Shingles are counted in ranges of about so many bytes of text, which a task folds one after another; the number of
#: ranges is a power of two, and the number of tasks is Spark's.
RANGE_BYTES = 8_000_000
LEAST_RANGE_BITS, MOST_RANGE_BITS = 5, 18
#: Size of the filter of repeated shingles that goes to every task: 2**27 bits are 16 MB.
FILTER_BITS = 27
MAX_CANDIDATES = 1_000_000
#: Documents and shingles of a cut of a block.
TILE, TILE_ITEMS = 1_000, 600_000

_U = np.uint64
_ONE_SEQUENCE = _U(0x5851F42D4C957F2D)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles of a sequence of word hashes; a shorter sequence is one shingle, none is none."""
    if len(words) >= n:
        return np.unique(windows(words, n))
    return mix(combine(words)[None] ^ _ONE_SEQUENCE) if len(words) else np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for block in text_blocks(batch.column("text"), NOT_SPACE):
        hashes, b = block.hashes(), block.bounds
        for r in range(block.n_rows):
            yield block.first_row + r, shingle_set(hashes[b[r] : b[r + 1]], n)


def _pack(values: np.ndarray) -> bytes:
    """Sorted 44-bit values as differences of four bytes where they fit."""
    steps = np.diff(values, prepend=_U(0))
    if len(steps) and steps.max() < 2**32:
        return b"4" + steps.astype(np.uint32).tobytes()
    return b"8" + steps.tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, np.uint32 if blob[:1] == b"4" else np.uint64, offset=1), dtype=np.uint64)


def range_bits(docs: DataFrame) -> int:
    """Leading bits of a shingle that name its range, by the size of all texts."""
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 1
    return min(MOST_RANGE_BITS, max(LEAST_RANGE_BITS, ceil(log2(total / RANGE_BYTES))))


def _counted(n: int, range_bits: int):
    ranges = 1 << range_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            values = np.sort(np.concatenate(held)) >> _U(20)
            part = values >> _U(44 - range_bits)
            cuts = np.searchsorted(part, np.arange(ranges + 1))
            rows = [(r, _pack(values[cuts[r] : cuts[r + 1]])) for r in np.flatnonzero(np.diff(cuts)).tolist()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["part", "packed"]
            )

        held, size = [], 0
        for batch in batches:
            for _, s in _sets(batch, n):
                held.append(s)
                size += len(held[-1])
                if size > 1_500_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: the filter bits of its repeated shingles, and the frequent ones with their counts."""
    for table in _by_part(batches):
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for k in range(0, len(table), 8):  # folded as it comes: only distinct values are held
            parts = [_unpack(x.as_py()) for x in table.column("packed")[k : k + 8]]
            new = np.concatenate([values, *parts])
            weights = np.concatenate([counts, np.ones(sum(map(len, parts)), np.int64)])
            order = np.argsort(new, kind="stable")
            new, weights = new[order], weights[order]
            first = np.flatnonzero(np.diff(new, prepend=new[:1] - _U(1)))
            values, counts = new[first], np.add.reduceat(weights, first)
        bits = np.unique(mix(values[counts > 1]) >> _U(64 - FILTER_BITS)).astype(np.int32)
        many = counts >= FREQUENT
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([bits.tobytes()], pa.binary()),
                pa.array([values[many].astype(np.int64)], pa.list_(pa.int64())),
                pa.array([counts[many]], pa.list_(pa.int64())),
            ],
            ["bits", "frequent", "counts"],
        )


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for table in whole_groups(batches, "part"):
        parts = table.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(parts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)


def shingle_order(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frequent shingles (cut to 44 bits, sorted), the rank of each by frequency, and the filter of repeated ones.

    All documents are counted. Only the order of shingles depends on the result, never which links are found.
    """
    spark = docs.sparkSession
    packed = docs.select("text").mapInArrow(_counted(n, range_bits(docs)), "part int, packed binary")
    found = packed.repartition("part").sortWithinPartitions("part")
    found = found.mapInArrow(_repeated, "bits binary, frequent array<bigint>, counts array<bigint>")
    found = materialize(found, "shingle-order")
    pairs = found.select(F.explode(F.arrays_zip("frequent", "counts")).alias("p")).select("p.frequent", "p.counts")
    least, kept = FREQUENT, 0
    by_count = pairs.groupBy(F.least("counts", F.lit(100_000)).alias("c")).count().orderBy(F.desc("c")).collect()
    for row in by_count:
        if kept + row["count"] > MAX_FREQUENT:
            least = row["c"] + 1
            break
        kept += row["count"]
    rows = pairs.filter(F.col("counts") >= least).limit(MAX_FREQUENT).toPandas()
    values, counts = rows["frequent"].to_numpy(np.int64).astype(np.uint64), rows["counts"].to_numpy(np.int64)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, counts))] = np.arange(len(values))
    order = np.argsort(values)
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in found.select("bits").toLocalIterator():
        at = np.frombuffer(row["bits"], np.int32)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return values[order], rank[order], bits


def _prefixes(n: int, share: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank, bits = order.value
        for batch in batches:
            ids, sizes, digests, keys, lists, places, lasts = [], [], [], [], [], [], []
            names = batch.column("doc_id")
            for row, s in _sets(batch, n):
                size = len(s)
                ids.append(names[row].as_py())
                sizes.append(size)
                digests.append(int(combine(s).view(np.int64)) if size else None)
                length = size - ceil(share * size / 100) + 1 if size else 0
                prefix, last = _prefix(s, length, frequent, rank)
                keys.append(int(combine(prefix).view(np.int64)) if size else None)
                lasts.append(last)
                short = prefix >> _U(20)
                at = mix(short) >> _U(64 - FILTER_BITS)
                again = ((bits[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1).astype(bool)
                lists.append(prefix[again].view(np.int64))
                places.append(np.flatnonzero(again).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(lasts, pa.list_(pa.int64())),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_shingles", "digest", "prefix_key", "last", "prefix", "places"],
            )

    return run


def _prefix(s: np.ndarray, length: int, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The first ``length`` shingles in the common order, and the place of the last of them in that order."""
    if not length:
        return s, [0, 0]
    if len(frequent):
        short = s >> _U(20)
        at = np.minimum(np.searchsorted(frequent, short), len(frequent) - 1)
        often = frequent[at] == short
    else:
        often = np.zeros(len(s), bool)
    rare = s[~often]
    if len(rare) >= length:
        return rare[:length], [0, int(rare[length - 1] >> _U(1))]
    late, late_rank = s[often], rank[at[often]]
    by_rank = np.lexsort((late, late_rank))[: length - len(rare)]
    return np.concatenate([rare, late[by_rank]]), [1 + int(late_rank[by_rank[-1]]), int(late[by_rank[-1]] >> _U(1))]


def _whole_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("doc_id")
            rows = [(names[row].as_py(), s.view(np.int64)) for row, s in _sets(batch, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.list_(pa.int64()))], ["doc_id", "items"]
            )

    return run


def _sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``doc_id``, ``items``: the whole sets of the documents ``ids`` (doc_id; repeats allowed), stored."""
    ids = materialize(ids.distinct(), "ngram-wanted")
    texts = docs.join(broadcast_if_bounded(ids, MAX_CANDIDATES), "doc_id", "left_semi")
    return materialize(texts.mapInArrow(_whole_sets(n), "doc_id bigint, items array<bigint>"), "ngram-sets")


def overlaps(items: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered ``left`` with those numbered ``right``."""
    owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
    _, at, counts = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    owner, first = owner[order], np.cumsum(counts) - counts
    out = np.zeros((len(left), len(right)), np.float32)
    row, column = np.full(len(items), -1), np.full(len(items), -1)
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    often = np.flatnonzero(counts > max(8, len(items) // 16))
    for k in range(0, len(often), 1024):  # shingles that many sets have: by a product of 0/1 matrices
        have = np.zeros((len(items), 1024), np.float32)
        for c, t in enumerate(often[k : k + 1024]):
            have[owner[first[t] : first[t] + counts[t]], c] = 1
        out += have[left] @ have[right].T
    for t in np.flatnonzero((counts > 1) & (counts <= max(8, len(items) // 16))).tolist():
        own = owner[first[t] : first[t] + counts[t]]
        i, j = row[own], column[own]
        i, j = i[i >= 0], j[j >= 0]
        if len(i) and len(j):
            out[np.ix_(i, j)] += 1
    return out


def _compare_tiles(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tile"):
            tiles = table.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tiles)) + 1), len(tiles)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = table.slice(a, b - a)
                ids, parts, side = (part.column(c).to_numpy() for c in ("rep", "part", "side"))
                items = [x.values.to_numpy() for x in part.column("items")]
                size = np.array([len(x) for x in items])
                # Side 0 and 1 are two cuts; where there is only side 0, a cut is compared with itself.
                left = np.flatnonzero(side == 0)
                right = np.flatnonzero(side == 1) if (side == 1).any() else left
                same = overlaps(items, left, right)
                linked = 100 * same >= share * (size[left][:, None] + size[right][None, :] - same)
                i, j = np.nonzero(linked & (parts[left][:, None] != parts[right][None, :]))
                nodes, roots = local_roots(ids[left[i]], ids[right[j]])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

    return run


def _cuts() -> Column:
    """Into how many cuts a set of documents goes, by their number and their shingles."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("n_shingles") / TILE_ITEMS)).cast("int")


def _compared(tiles: DataFrame, share: int, name: str) -> DataFrame:
    tiles = tiles.repartition("tile").sortWithinPartitions("tile")
    return materialize(tiles.mapInArrow(_compare_tiles(share), "a bigint, b bigint"), name)


def _inner_links(labelled: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Edges (a, b) that connect what links inside the blocks that are not one component yet.

    A block of many or long documents is cut, and every two cuts of it are a tile; pairs never leave the tile's task.
    """
    blocks = labelled.groupBy("block").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), _cuts().alias("cuts")).filter("lo < hi")
    blocks = blocks.select("block", "cuts")
    rows = labelled.select("rep", "part", "block").join(blocks, "block").join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    mine = F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")
    to = F.transform(
        F.sequence(F.lit(0), F.col("cuts") - 1),
        lambda k: F.struct(F.least(mine, k).alias("row"), F.greatest(mine, k).alias("column"), (mine > k).cast("int").alias("side")),
    )
    tiles = rows.select("rep", "part", "items", "block", F.explode(to).alias("t"))
    tiles = tiles.select("rep", "part", "items", F.col("t.side").alias("side"), F.xxhash64("block", "t.row", "t.column").alias("tile"))
    return _compared(tiles, share, "ngram-inner")


def _outer_links(near: DataFrame, labelled: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Edges (a, b) that connect the members of groups ``a`` with what they link with in the blocks ``b_block``.

    The members visit the block: every cut of the visitors meets every cut of the block in a tile, so that the rows
    grow with the visits and not with the pairs in them.
    """
    rows = labelled.select("rep", "gid", "part", "n_shingles", "block")
    guests = rows.drop("block").join(near.select(F.col("a").alias("gid"), F.col("b_block").alias("block")), "gid")
    hosts = rows.join(near.select(F.col("b_block").alias("block")).distinct(), "block")
    cuts = guests.groupBy("block").agg(_cuts().alias("guest_cuts")).join(hosts.groupBy("block").agg(_cuts().alias("host_cuts")), "block")
    own, other = (lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")), (lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)))
    guests = guests.join(cuts, "block").select("rep", "part", "block", F.lit(0).alias("side"), own("guest_cuts").alias("row"), other("host_cuts").alias("column"))
    hosts = hosts.join(cuts, "block").select("rep", "part", "block", F.lit(1).alias("side"), other("guest_cuts").alias("row"), own("host_cuts").alias("column"))
    tiles = guests.unionByName(hosts).join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    return _compared(tiles.select("rep", "part", "items", "side", F.xxhash64("block", "row", "column").alias("tile")), share, "ngram-outer")


def _similar_sizes(share: int) -> Column:
    return 100 * F.least("na", "nb") >= share * F.greatest("na", "nb")


def _near_blocks(tokens: DataFrame, labelled: DataFrame, share: int) -> DataFrame:
    """Groups ``a`` and larger blocks ``b_block`` whose common prefix shingles are enough for a link with some member.

    A member has no more shingles in common with the group than its block has, nor a size beyond those of its block.
    """
    sizes = labelled.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    tokens = tokens.select("token", "gid", "n", "before", "after", "block").join(sizes, "block")
    left = tokens.select(
        "token", F.col("gid").alias("a"), F.col("n").alias("a_n"), F.col("before").alias("a_before"), F.col("after").alias("a_after"), F.struct("size", "block").alias("a_key")
    )
    # The most that members with the shingle have before it, from it on, and in all.
    right = tokens.groupBy("token", F.struct("size", "block").alias("b_key"), "least", "most").agg(
        F.max("before").alias("b_before"), F.max("after").alias("b_after"), F.max(F.col("before") + F.col("after")).alias("b_all")
    )
    common = F.least(F.least("a_before", "b_before") + F.least("a_after", "b_after"), F.col("a_before") + F.col("a_after"), "b_all")
    room = (100 + share) * common >= share * (F.col("a_n") + F.greatest("least", F.ceil(F.lit(share) * F.col("a_n") / 100)))
    pairs = left.join(right, "token").filter("a_key < b_key").filter(room)
    pairs = pairs.groupBy("a", "a_n", F.col("b_key.block").alias("b_block"), "least", "most").agg(F.count(F.lit(1)).alias("common"))
    rest = F.ceil(F.lit(share) * F.greatest("a_n", "most") / 100) - 1
    smallest = F.greatest("least", F.ceil(F.lit(share) * F.col("a_n") / 100))
    fits = (100 * F.col("most") >= share * F.col("a_n")) & (100 * F.col("a_n") >= share * F.col("least"))
    enough = (100 + share) * (F.col("common") + rest) >= share * (F.col("a_n") + smallest)
    return materialize(pairs.filter(fits & enough).select("a", "b_block"), "ngram-near")


def _links(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose whole sets overlap enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("left_items"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("right_items"))
    both = F.size(F.array_intersect("left_items", "right_items"))
    union = F.size("left_items") + F.size("right_items") - both
    return pairs.select("a", "b").join(left, "a").join(right, "b").filter(100 * both >= share * union).select("a", "b")


def _promising(pairs: DataFrame, groups: DataFrame, share: int) -> DataFrame:
    """Group pairs (a, b, common) that size and shared prefix shingles allow.

    All shingles of both up to the smaller of the two prefix ends are in both prefixes, so the overlap is at most
    the common ones plus what follows the prefix that ends first.
    """
    g = groups.select("gid", "n_shingles", "last")
    for side in "ab":
        pairs = pairs.join(g.select(F.col("gid").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("last").alias(f"last_{side}")), side)
    rest = lambda n: F.ceil(F.lit(share) * F.col(n) / 100) - 1  # noqa: E731  what follows the prefix
    most = F.col("common") + F.when(F.col("last_a") < F.col("last_b"), rest("na")).when(
        F.col("last_b") < F.col("last_a"), rest("nb")
    ).otherwise(F.least(rest("na"), rest("nb")))
    return pairs.filter(_similar_sizes(share)).filter((100 + share) * most >= share * (F.col("na") + F.col("nb")))


def ngram_components(docs: DataFrame, n: int = 5, share: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``docs`` (doc_id unique, text; others are ignored).

    Words are runs of other than white space, A-Z in lower case. Documents link when 100 * intersection >= share *
    union of their sets of distinct ``n``-word shingles; a text of fewer words is one shingle. A null or empty text
    has an empty set and links with nothing; rows without a doc_id are left out. Texts are read whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    docs = spread(docs, docs)
    order = spark.sparkContext.broadcast(shingle_order(docs, n))
    prefixes = docs.mapInArrow(
        _prefixes(n, share, order),
        "doc_id bigint, n_shingles bigint, digest bigint, prefix_key bigint, last array<bigint>, prefix array<bigint>, places array<int>",
    )
    prefixes = materialize(prefixes, "ngram-prefixes")
    full = prefixes.filter("n_shingles > 0")

    # Equal sets are one class, equal prefixes and sizes one group; both are named by their smallest document.
    classes = full.groupBy("n_shingles", "digest").agg(F.min("doc_id").alias("rep"), F.first("prefix_key").alias("prefix_key"))
    classes = materialize(classes, "ngram-classes")
    groups = classes.groupBy("n_shingles", "prefix_key").agg(F.min("rep").alias("gid"))
    groups = materialize(groups.join(prefixes.select(F.col("doc_id").alias("gid"), "last", "prefix", "places"), "gid"), "ngram-groups")
    members = classes.join(groups.select("n_shingles", "prefix_key", "gid"), ["n_shingles", "prefix_key"]).select("rep", "gid", "n_shingles")
    members = materialize(members, "ngram-members")

    postings = groups.select("gid", F.col("n_shingles").alias("n"), F.explode(F.arrays_zip("prefix", "places")).alias("p"))
    postings = postings.select("gid", "n", F.col("p.prefix").alias("token"), F.col("p.places").alias("i"))
    shared = postings.groupBy("token").agg(F.min("gid").alias("low"), F.max("gid").alias("high")).filter("low < high")
    shared = materialize(postings.join(shared, "token"), "ngram-postings")
    pivots = shared.select("token", F.col("gid").alias("b"), F.explode(F.array("low", "high")).alias("a")).filter("a <> b")
    pivots = pivots.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "token").distinct()
    pivots = _promising(pivots.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common")), groups, share).select("a", "b")
    inside = members.filter("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    first = materialize(pivots.unionByName(inside), "ngram-pivots")
    sets = _sets_of(docs, first.select(F.explode(F.array("a", "b")).alias("doc_id")), n)
    links = materialize(_links(first, sets, share), "ngram-links")
    found = materialize(connected(links, "ngram-first"), "ngram-found")

    # What the promising pairs connect, links or not, is a block. Inside a block all that is not yet connected is compared.
    blocks = connected(first, "ngram-blocks").select(F.col("node").alias("rep"), F.col("component_id").alias("block"))
    labelled = members.join(blocks, "rep", "left").join(found.select(F.col("node").alias("rep"), F.col("component_id").alias("part")), "rep", "left")
    labelled = labelled.select("rep", "gid", "n_shingles", F.coalesce("block", "rep").alias("block"), F.coalesce("part", "rep").alias("part"))
    labelled = materialize(labelled, "ngram-labelled")
    inner = _inner_links(labelled, sets, share)

    # Across blocks, groups are paired with larger blocks by the shingles that several blocks have.
    of_group = labelled.select("gid", "block").distinct()  # a group is in one block: its members are paired with its name
    tokens = shared.select("token", "gid", "n", "i").join(of_group, "gid")
    mixed = tokens.groupBy("token").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo < hi").select("token")
    # What a group may share with another block before a shingle is in both prefixes, so it is one of these shingles too.
    earlier = F.row_number().over(Window.partitionBy("gid").orderBy("i")) - 1
    tokens = tokens.join(mixed, "token").select("token", "gid", "n", "block", earlier.alias("before"), (F.col("n") - F.col("i")).alias("after"))
    tokens = materialize(tokens, "ngram-open")
    near = _near_blocks(tokens, labelled, share)
    visited = labelled.join(near.select(F.col("b_block").alias("block")).distinct(), "block", "left_semi").select(F.col("rep").alias("doc_id"))
    visitors = labelled.join(near.select(F.col("a").alias("gid")).distinct(), "gid", "left_semi").select(F.col("rep").alias("doc_id"))
    more = _outer_links(near, labelled, _sets_of(docs, visited.unionByName(visitors), n), share)
    found = connected(links.unionByName(inner).unionByName(more), "ngram-all")

    names = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    names = names.select("n_shingles", "digest", F.coalesce("component_id", "rep").alias("component_id"))
    out = prefixes.select("doc_id", "n_shingles", "digest").join(names, ["n_shingles", "digest"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document with the smallest id of each group of near copies stays; all columns stay.

    Rows without a doc_id are not compared and stay as they are.
    """
    kept = ngram_components(docs).filter("doc_id = component_id").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_ngram_join": op4_ngram_join}
SQL = {
    "op4_ngram_join": r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
shingled as (
    select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
    from words
),
sets as (select doc_id, coalesce(len(s), 0) as n, min(doc_id) over (partition by list_sort(s)) as rep, s from shingled),
items as (select doc_id, n, unnest(s) as item from sets where doc_id = rep),
links as (
    select a.doc_id as a, b.doc_id as b from items a join items b on a.item = b.item and a.doc_id <> b.doc_id
    where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.doc_id, b.doc_id having 100 * count(*) >= 80 * (min(a.n) + min(b.n) - count(*))
),
reach as (
    select distinct a as node, a as other from links
    union
    select reach.node, links.b from reach join links on links.a = reach.other
),
parts as (select node, min(other) as part from reach group by node)
select doc_id, n as n_shingles,
    case when n = 0 then doc_id else coalesce(part, rep) end as component_id
from sets left join parts on node = rep
""",
}
