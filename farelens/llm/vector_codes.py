"""Compression of vectors to codes of a few bytes by integer codebooks, exactly and without floating point.

Components become integers; a vector is cut into equal parts, and each part position has a codebook of integer entries
that a fixed number of rounds improves. Parts and entries are padded with zeros to a power of two and transformed by
the integer Walsh-Hadamard transform, which multiplies every squared distance by that power. In the order of sequency
(sign changes of the basis) the first coefficients hold most of a distance, so the scaled squared differences are added
up in this order and an entry is left out as soon as its sum exceeds the whole distance of another one. What is left
has been compared in all coefficients, and ties go to the lower index.

A round is one pass over the vectors: each task adds up the parts of every entry, and only these sums leave it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import broadcast_if_bounded, materialize, spread

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096

_LIMB_BITS = 31
_LONG = 2**63 - 1


def valid(embedding: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components there and finite."""
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(finite, F.lit(False))


def to_integers(raw: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floor of ``scale`` times each component: 64-bit where that is safe for the distances, else Python integers."""
    x = raw.astype(np.float64)
    if not x.size or np.abs(x).max() < 2.0**40:
        return np.floor(x * scale).astype(np.int64)  # a power of two: the product is exact
    whole = np.vectorize(lambda v: int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(v * scale)), otypes=[object])
    return whole(x)


def fits_long(largest: int, width: int) -> bool:
    """Whether scaled squared distances of parts of ``width`` (a power of two) with such components fit in 64 bits."""
    return 4 * width**3 * (largest + 1) ** 2 < 2**62


def _power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def sequency_order(width: int) -> np.ndarray:
    """Columns of the transform by the sign changes of their basis vectors."""
    basis = _butterflies(np.eye(width, dtype=np.int64))
    return np.argsort(np.count_nonzero(np.diff(basis, axis=1), axis=1), kind="stable")


def _butterflies(x: np.ndarray) -> np.ndarray:
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x


def walsh(x: np.ndarray) -> np.ndarray:
    """The integer transform of rows padded with zeros, in sequency order."""
    n, size = x.shape
    width = _power_of_two(size)
    padded = np.zeros((n, width), x.dtype)
    padded[:, :size] = x
    return _butterflies(padded)[:, sequency_order(width)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lowest of equal ones) and scaled squared distance, of transformed rows."""
    n, width = parts.shape
    head = min(2, width)
    sums = ((parts[:, None, :head] - entries[None, :, :head]) ** 2).sum(axis=2)
    # The whole distance of the entry that leads so far bounds that of the nearest one.
    leader = sums.argmin(axis=1)
    bound = ((parts - entries[leader]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    while head < width:
        more = slice(head, min(2 * head, width))
        sums = sums + ((parts[row, more] - entries[entry, more]) ** 2).sum(axis=1)
        stays = (sums <= bound[row]).astype(bool)
        row, entry, sums = row[stays], entry[stays], sums[stays]
        head = more.stop
    order = np.lexsort((entry, sums, row)) if sums.dtype != object else np.array(sorted(range(len(row)), key=lambda i: (row[i], sums[i], entry[i])), int)
    first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    return entry[first], sums[first]


@dataclass
class Codebooks:
    """``entries``: parts x entries x components of a part, as integers."""

    size: int
    scale: int
    entries: np.ndarray = field(repr=False)

    @property
    def width(self) -> int:
        return _power_of_two(self.entries.shape[2])

    def parts_of(self, x: np.ndarray) -> np.ndarray:
        """Integer rows as rows x parts x components; what is missing at the end of the last part is zero."""
        parts, _, width = self.entries.shape
        out = np.zeros((len(x), parts * width), x.dtype)
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), parts, width)

    def assign(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Integer parts, entry indices and squared distances (rows x parts) of vectors."""
        x = self.parts_of(to_integers(raw, self.scale))
        entries = self.entries
        largest = max((int(abs(a).max()) for a in (x, entries) if a.size), default=0)
        kind = np.int64 if fits_long(largest, self.width) else object
        x, entries = x.astype(kind), entries.astype(kind)
        code, distance = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], kind)
        for part in range(x.shape[1]):
            code[:, part], scaled = nearest(walsh(x[:, part]), walsh(entries[part]))
            distance[:, part] = scaled // self.width
        return x, code, distance

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def _rows(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.asarray(batch.column("embedding").flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, size)


def _limbs(value: int) -> list[int]:
    out = []
    while not -(2**_LIMB_BITS) <= value < 2**_LIMB_BITS:
        out.append(value & (2**_LIMB_BITS - 1))
        value >>= _LIMB_BITS
    return [*out, value]


SUMS = "part int, entry int, at int, limb int, value bigint"


def _sums(books: Codebooks):
    """Count (at -1) and componentwise sums of the parts of each entry, over a task; large numbers in several limbs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.entries.shape
        totals = np.zeros((parts, entries, width + 1), object)
        for batch in batches:
            x, code, _ = books.assign(_rows(batch, books.size))
            for part in range(parts):
                for entry in np.unique(code[:, part]):
                    mine = x[code[:, part] == entry, part]
                    totals[part, entry, 0] += len(mine)
                    totals[part, entry, 1:] += mine.sum(axis=0).astype(object)
        found = [(p, e, at - 1, k, limb) for p, e, at in np.argwhere(totals != 0).tolist() for k, limb in enumerate(_limbs(int(totals[p, e, at])))]
        columns = zip(*found, strict=True) if found else [[]] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["part", "entry", "at", "limb", "value"])

    return run


def _kept(vectors: DataFrame, size: int | None = None) -> DataFrame:
    kept = vectors.select("vec_id", "embedding", "label").filter(valid(F.col("embedding")))
    return kept if size is None else kept.filter(F.size("embedding") == size)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of ``vectors`` (vec_id, embedding, label); None if no vector takes part.

    The first entries are the parts of the vectors with the smallest vec_ids (null ids last, repeated ids by their
    components). They also set the length: vectors of another length take no part. Each round reads all vectors.
    """
    seeds = _kept(vectors).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    if not seeds:
        return None
    size = len(seeds[0][0])
    first = np.array([r[0] for r in seeds if len(r[0]) == size])
    if len(first) < len(seeds):
        same = _kept(vectors, size).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
        first = np.array([r[0] for r in same])
    books = Codebooks(size, scale, np.zeros((parts, len(first), -(-size // parts)), object))
    books.entries = books.parts_of(to_integers(first, scale)).astype(object).transpose(1, 0, 2)
    kept = _kept(vectors, size)
    for _ in range(rounds):
        summed = spread(kept, kept).select("embedding").mapInArrow(_sums(books), SUMS).groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value"))
        totals = np.zeros((parts, len(first), books.entries.shape[2] + 1), object)
        for part, entry, at, limb, value in summed.collect():  # as many rows as the codebooks have numbers, times limbs
            totals[part, entry, at + 1] += value << (_LIMB_BITS * limb)
        used = totals[:, :, 0] > 0
        updated = books.entries.copy()
        updated[used] = totals[used][:, 1:] // totals[used][:, :1]
        books = Codebooks(size, scale, updated)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hexadecimal digits a part) and ``error`` of every vector that takes part.

    An error above the range of long is given as the largest long.
    """
    kept = _kept(vectors, books.size)
    label = kept.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, code, distance = books.assign(_rows(batch, books.size))
            error = [min(int(e), _LONG) for e in distance.sum(axis=1)]
            codes = [bytes(row).hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"]
            )

    kept = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    return spread(kept, kept).mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")


def reconstruct(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``embedding``: the entries that a code names, scaled back to floating point."""
    size, values = books.size, books.entries.astype(np.float64) / books.scale

    @F.pandas_udf("array<double>")
    def decoded(code):
        index = np.array([list(bytes.fromhex(c)) for c in code], int).reshape(len(code), -1)
        joined = values[np.arange(index.shape[1]), index].reshape(len(code), -1)[:, :size]
        return code.__class__(list(joined), index=code.index)

    return codes.withColumn("embedding", decoded("code"))


def compress(vectors: DataFrame) -> DataFrame:
    """Codes, errors and the errors of all vectors of the same label, with the digest of the codebooks.

    Vectors that are null or empty, or hold null or non-finite components, are left out; so are vectors of another
    length than that of the smallest vec_id. Parts of a length that the parts do not divide are padded with zeros.
    Repeated rows and vec_ids and null vec_ids each have a row; null labels count together; other columns are
    ignored; without vectors there are no rows.
    """
    spark = vectors.sparkSession
    books = train(vectors)
    if books is None:
        schema = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return spark.createDataFrame([], schema)
    coded = materialize(encode(vectors, books), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy("label").agg(F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    # A hot label is summed before the shuffle; its few totals go to the vectors, not the vectors to them.
    labels = broadcast_if_bounded(labels.withColumnRenamed("label", "of"))
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _statement() -> str:
    """SQL for vectors of one length that the parts divide: the rounds one after another."""
    ctes = [
        """kept as materialized (
  select row_number() over (order by vec_id) as r, vec_id, label, embedding from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0)""",
        f"""cells as materialized (
  select r, cast((i - 1) // (len(embedding) // {PARTS}) as bigint) as part, (i - 1) % (len(embedding) // {PARTS}) as pos,
         cast(floor(cast(embedding[i] as double) * {SCALE}) as bigint) as x
  from (select r, embedding, unnest(range(1, len(embedding) + 1)) as i from kept))""",
        f"book0 as materialized (select part, r - 1 as entry, pos, x as y from cells where r <= {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        ctes.append(f"""nearest{k} as materialized (
  select r, part, min(d * {ENTRIES} + entry) as best from (
    select r, part, entry, sum(cast((x - y) * (x - y) as hugeint)) as d from cells join book{k} using (part, pos) group by r, part, entry)
  group by r, part)""")
        if k < ROUNDS:
            ctes.append(f"""book{k + 1} as materialized (
  select part, entry, pos, coalesce((s - ((s % n) + n) % n) // n, y) as y from book{k} left join (
    select part, cast(best % {ENTRIES} as bigint) as entry, pos, sum(x) as s, count(*) as n
    from cells join nearest{k} using (r, part) group by part, best % {ENTRIES}, pos) using (part, entry, pos))""")
    ctes.append(f"""coded as (
  select r, string_agg(printf('%02x', cast(best % {ENTRIES} as int)), '' order by part) as code, cast(sum(best // {ENTRIES}) as bigint) as error
  from nearest{ROUNDS} group by r)""")
    return f"""with {', '.join(ctes)}
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(cast(y as bigint) as varchar), ',' order by part, entry, pos)) from book{ROUNDS}) as codebooks_sha256
from coded join kept using (r)"""


QUERIES = {"op11_vector_codes": op11_vector_codes}
SQL = {"op11_vector_codes": _statement()}
