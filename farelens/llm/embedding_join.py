"""Embedding near-dedup: vectors of one label with a cosine above a bound, by a subspace pigeonhole join.

For unit vectors a cosine of c is a squared distance of 2 - 2c. A rotation keeps distances; after it the coordinates
are dealt to a few low-dimensional blocks, and the allowed squared distance is split over the blocks in proportion
to their variance. If two vectors are within the distance, then in at least one block they are within that block's
budget. So each block gets a range join of its own: vectors go to the cells of a grid over the block's leading
coordinates, to their own cell as seekers and to all cells within the budget as partners, and the block's distances
are compared inside a cell. What passes is compared by the cosine of the original components, and a pair counts in
the first block whose budget it keeps, so that the union over blocks needs no further shuffle.

The vectors of a label are dealt to parts, and each task makes the range joins of all blocks for two parts. So a vector is
sent as often as its label has parts, once for most, rather than once for each of its cells. Pairs never leave a task: what
does are the number of partners of each vector and, for the components, one edge from each vector of a task to the
smallest it is connected with there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm.components import connected, local_roots
from farelens.llm.words import small_batches, whole_groups
from farelens.session import broadcast_if_bounded, materialize

COSINE = 0.93
BLOCK_DIMENSIONS = 8
#: Leading coordinates of a block that make up the grid, and the width of a cell in budgets.
GRID = 2
WIDTH = 3.0
#: Vectors that the rotation is fitted on, those with the smallest hashes. Links do not depend on it.
ROTATION_SAMPLE = 4_000
#: Vectors of a part of a label, about. A task holds two parts.
TILE = 40_000
#: Room for rounding in distances; the cosine decides.
SLACK = 1e-6
#: More than single precision can be off in the cosine or the squared distance of two unit vectors.
_ROUGH = 1e-3

_DISTANCES = 2_000_000
_PAIRS = 50_000


def valid(embedding: Column) -> Column:
    """Whether a vector can link: not null or empty, all components finite, not zero."""
    x = embedding.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def fit_rotation(sample: np.ndarray, dimensions: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Rotation (columns are axes by falling variance), the axes of each block, and the blocks' shares of the budget."""
    if len(sample):
        values, axes = np.linalg.eigh(sample.T @ sample / len(sample))
        values, axes = np.maximum(values[::-1], 1e-9), axes[:, ::-1]
    else:
        values, axes = np.ones(dimensions), np.eye(dimensions)
    n = max(1, dimensions // BLOCK_DIMENSIONS)
    blocks = [np.arange(dimensions)[k::n] for k in range(n)]
    variance = np.array([values[b].sum() for b in blocks])
    return axes, blocks, variance / variance.sum()


def _cells(lead: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The own cell of each vector, and all cells within reach of it, sorted, with the vector of each."""
    width = WIDTH * reach

    def key(cell: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cell), np.int64)
        for c in range(cell.shape[1]):
            out = out * (1 << 31) + cell[:, c]
        return out

    low, high = np.floor((lead - reach) / width).astype(np.int64), np.floor((lead + reach) / width).astype(np.int64)
    keys, rows = [], []
    for step in np.ndindex(*[int(w) + 1 for w in (high - low).max(axis=0, initial=0)]):
        cell = low + np.array(step)
        take = np.flatnonzero((cell <= high).all(axis=1))
        keys.append(key(cell[take]))
        rows.append(take)
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    order = np.argsort(keys, kind="stable")
    return key(np.floor(lead / width).astype(np.int64)), keys[order], rows[order]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(rotation, cosine: float, bound: float):
    """Count the partners of each vector of a tile, and connect linked vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tile"):
            tiles = table.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tiles)) + 1), len(tiles)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield _tile(table.slice(a, b - a), *rotation.value, cosine, bound)

    return run


def _tile(table: pa.Table, axes, blocks, shares, cosine: float, bound: float) -> pa.RecordBatch:
    raw = table.column("embedding").combine_chunks()
    x = _unit(np.asarray(raw.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(raw), -1))
    rotated, rough = x @ axes, x.astype(np.float32)
    turned = rotated.astype(np.float32)
    ids, weights, part = (table.column(c).to_numpy() for c in ("rep", "copies", "part"))
    both = not table.column("alone")[0].as_py()
    limits = bound * shares + SLACK
    # One part is compared with itself, two parts with each other.
    seekers = np.flatnonzero(part == part[0])
    partners = np.flatnonzero(part != part[0]) if both else seekers
    counts = np.zeros(len(ids), np.int64)
    left, right = [], []
    for block, (dims, share) in enumerate(zip(blocks, shares, strict=True)):
        reach = np.sqrt(bound * share) + SLACK
        own = _cells(rotated[seekers][:, dims[:GRID]], reach)[0]
        _, cells, at = _cells(rotated[partners][:, dims[:GRID]], reach)
        order = np.argsort(own, kind="stable")
        own, mine = own[order], seekers[order]
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            near = np.sort(partners[at[np.searchsorted(cells, own[a]) : np.searchsorted(cells, own[a], "right")]])
            step = max(1, _DISTANCES // max(1, len(near)))
            for s in (mine[k : min(k + step, b)] for k in range(a, b, step)):
                if not both:  # of two vectors of one part, the first is the seeker
                    near = near[np.searchsorted(near, s[0], "right") :]
                # By single precision first, as most pairs that one block lets pass are far apart in the others.
                close = rough[s] @ rough[near].T >= cosine - _ROUGH
                close &= _distance(turned[s][:, dims], turned[near][:, dims]) <= limits[block] + _ROUGH
                i, j = np.nonzero(close)
                for begin in range(0, len(i), _PAIRS):
                    si, pj = s[i[begin : begin + _PAIRS]], near[j[begin : begin + _PAIRS]]
                    apart = rotated[si] - rotated[pj]
                    apart *= apart
                    # Counted in the first block that lets it pass, and only if it is another vector.
                    linked = (ids[si] != ids[pj]) & (apart[:, dims].sum(axis=1) <= limits[block]) & (both | (si < pj))
                    for b0 in range(block):
                        linked &= apart[:, blocks[b0]].sum(axis=1) > limits[b0]
                    si, pj = si[linked], pj[linked]
                    linked = (x[si] * x[pj]).sum(axis=1) >= cosine
                    si, pj = si[linked], pj[linked]
                    np.add.at(counts, si, weights[pj])
                    np.add.at(counts, pj, weights[si])
                    # Only one edge from each vector to the smallest it is connected with is kept of many pairs.
                    nodes, roots = local_roots(ids[si], ids[pj])
                    left.append(nodes)
                    right.append(roots)
    left, right = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (left, right))
    nodes, roots = local_roots(left, right)
    at = np.minimum(np.searchsorted(nodes, ids), max(len(nodes) - 1, 0))
    root = np.where(nodes[at] == ids, roots[at], ids) if len(nodes) else ids
    keep = (counts > 0) | (ids != root)
    return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (ids, counts, root)], ["rep", "n", "root"])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` from those of ``b``."""
    one, square = np.ones_like(a[:, :1]), lambda x: (x * x).sum(axis=1, keepdims=True)
    return np.hstack([square(a), one, -2 * a]) @ np.hstack([np.ones_like(b[:, :1]), square(b), b]).T


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors`` (vec_id unique, embedding, label).

    Vectors link if their labels are equal and not null, they have the same number of components and their cosine is
    at least ``cosine``. Vectors that are null, empty or zero or hold null or non-finite components link with
    nothing. Equal vectors of a label are compared once, whatever their number. Rows without vec_id are left out,
    extra columns ignored. All links are found.
    """
    spark = vectors.sparkSession
    small_batches(spark, 1_000)
    vectors = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding"), "label").filter("vec_id is not null")
    usable = vectors.filter(valid(F.col("embedding")) & F.col("label").isNotNull())
    usable = usable.withColumn("key", F.unhex(F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.to_json("embedding")), 256)))
    copies = materialize(usable.select("vec_id", "key"), "vector-keys")
    classes = materialize(copies.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    # Vectors that stand for themselves alone, as a rule all but a few, are not moved.
    others = materialize(copies.select("vec_id").join(classes.select(F.col("rep").alias("vec_id")), "vec_id", "left_anti").distinct(), "vector-copies")
    per_rep = classes.groupBy("rep").agg(F.collect_list("copies").alias("copies")).filter((F.size("copies") > 1) | (F.col("copies")[0] > 1))
    per_rep = broadcast_if_bounded(materialize(per_rep.withColumnRenamed("rep", "vec_id"), "vector-weights"))
    single = usable.drop("key").join(broadcast_if_bounded(others), "vec_id", "left_anti").join(per_rep, "vec_id", "left")
    weight = F.explode(F.coalesce("copies", F.array(F.lit(1).cast("bigint"))))
    single = materialize(single.select(F.col("vec_id").alias("rep"), "label", F.size("embedding").alias("size"), weight.alias("copies"), "embedding"), "vectors")
    bound = 2 - 2 * cosine
    found = None
    for row in single.select("size").distinct().orderBy("size").toLocalIterator():  # one size for all, as a rule
        part = _links(single.filter(F.col("size") == row["size"]).drop("size"), row["size"], cosine, bound)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "rep bigint, n bigint, root bigint")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-parts")
    per_class = classes.join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    per_class = per_class.select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    linked = copies.join(per_class, "key").drop("key")
    out = vectors.select("vec_id").join(linked, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))


def _links(single: DataFrame, size: int, cosine: float, bound: float) -> DataFrame:
    """``rep``, ``n`` (rows linked with), ``root`` (a smaller vector connected with it) for vectors of one size."""
    spark = single.sparkSession
    drawn = single.orderBy(F.xxhash64("rep"), "rep").limit(ROTATION_SAMPLE).select("embedding").collect()
    sample = _unit(np.array([r["embedding"] for r in drawn], np.float64).reshape(-1, size))
    rotation = spark.sparkContext.broadcast(fit_rotation(sample, size))
    parts = single.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    dealt = single.join(broadcast_if_bounded(materialize(parts, "label-parts")), "label")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.xxhash64("label", F.least("part", "other"), F.greatest("part", "other"))
    dealt = dealt.select("rep", "copies", "part", (F.col("part") == F.col("other")).alias("alone"), "embedding", tile.alias("tile")).repartition("tile").sortWithinPartitions("tile")
    return materialize(dealt.mapInArrow(_compare(rotation, cosine, bound), "rep bigint, n bigint, root bigint"), "vector-links")


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op3_embedding_join": op3_embedding_join}
SQL = {
    "op3_embedding_join": """
with recursive vectors as (
    select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings where label is not null
),
links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.label = b.label and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.93
),
counts as (select a, count(*) as n from links group by a),
reach as (
    select distinct a as node, a as other from links
    union
    select reach.node, links.b from reach join links on links.a = reach.other
),
parts as (select node, min(other) as part from reach group by node)
select vec_id, coalesce(n, 0) as n_links, coalesce(part, vec_id) as component_id, coalesce(part, vec_id) = vec_id as kept
from embeddings left join counts on a = vec_id left join parts on node = vec_id
"""
}
