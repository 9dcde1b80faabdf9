"""Benchmark decontamination by a distributed positional inverted index.

The index holds, for each segment of documents and each term, the places of the term: ``bases`` numbers the words of a
segment's documents one after another, so that one sorted list of integers serves for documents and positions. Lists
never leave their segment, so a term that stands in every document has many short lists rather than one long one.

A search looks at each phrase in each segment: the list of its rarest term there, moved by the term's place in the
phrase, is cut down by the lists of the other terms, rarest first. What is left are the places of exact matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm.words import ALPHANUMERIC, small_batches, text_blocks, windows
from farelens.session import materialize, spread

WINDOW = 10
#: Words of a segment, unless one document alone has more.
SEGMENT_WORDS = 400_000
#: A segment is a row of some megabytes; readers and writers hold one row group.
ROW_GROUP_BYTES = 8 << 20
#: Phrase words that go to the tasks at once (8 bytes each); larger benchmarks are searched in as many passes.
BLOCK_WORDS = 1_000_000

INDEX = "doc_ids array<bigint>, bases array<int>, terms array<bigint>, starts array<int>, places array<int>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Document ids, words before each document and term of each word, for one segment after another."""
    ids, sizes, terms, total = [], [], [], 0
    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        for block in text_blocks(batch.column("text"), ALPHANUMERIC):
            hashes, b = block.hashes().view(np.int64), block.bounds
            counts = np.diff(b)
            row = 0
            while row < block.n_rows:
                last = max(row + 1, int(np.searchsorted(b, b[row] + SEGMENT_WORDS - total, "right")) - 1)
                ids.extend(names[block.first_row + row : block.first_row + last])
                sizes.append(counts[row:last])
                terms.append(hashes[b[row] : b[last]])
                total += int(b[last] - b[row])
                row = last
                if total >= SEGMENT_WORDS or row < block.n_rows:
                    yield ids, np.concatenate(sizes), np.concatenate(terms)
                    ids, sizes, terms, total = [], [], [], 0
    if ids:
        yield ids, np.concatenate(sizes), np.concatenate(terms)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sizes, words in _segments(batches):
        bases = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        places = np.argsort(words, kind="stable").astype(np.int32)
        by_term = words[places]
        first = np.flatnonzero(np.concatenate([[True], by_term[1:] != by_term[:-1]])) if len(words) else np.zeros(0, np.int64)
        starts = np.append(first, len(words)).astype(np.int32)
        row = [ids, bases, by_term[first], starts, places]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.list_(t)) for x, t in zip(row, [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()], strict=True)],
            ["doc_ids", "bases", "terms", "starts", "places"],
        )


def build_index(docs: DataFrame) -> DataFrame:
    """The positional index of ``docs`` (doc_id, text), stored with one row for each segment.

    ``terms`` are sorted; the list of term k is ``places[starts[k] : starts[k + 1]]``, ascending. Document d of
    ``doc_ids`` has the places from ``bases[d]`` to ``bases[d + 1]``. A null text has no words. Rows without a doc_id
    are left out.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    return materialize(spread(docs, docs).mapInArrow(_index, INDEX), "phrase-index", row_group_bytes=ROW_GROUP_BYTES)


def _phrase_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = batch.column("item_id").to_pylist()
        for block in text_blocks(batch.column("text"), ALPHANUMERIC):
            hashes, b = block.hashes().view(np.int64), block.bounds
            rows = [(items[block.first_row + r], hashes[b[r] : b[r + 1]]) for r in range(block.n_rows) if b[r] < b[r + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(i) for i, _ in rows], pa.string()), pa.array([w for _, w in rows], pa.list_(pa.int64()))], ["item_id", "words"]
            )


def _blocks(items: DataFrame) -> Iterator[list[tuple[str, np.ndarray]]]:
    """The items in blocks of a bounded number of words; only one block is held at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        words = np.array(row["words"], np.int64)
        # An item too long for a block is cut into overlapping parts; its windows stay whole.
        for start in range(0, max(1, len(words) - WINDOW + 1), BLOCK_WORDS):
            part = words[start : start + BLOCK_WORDS + WINDOW - 1]
            if block and size + len(part) > BLOCK_WORDS:
                yield block
                block, size = [], 0
            block.append((row["item_id"], part))
            size += len(part)
    if block:
        yield block


def match_places(lists: dict[int, np.ndarray], phrase: np.ndarray) -> np.ndarray:
    """Where in a segment the phrase begins: lists moved by the term's place are intersected from the rarest on."""
    sizes = [(len(lists[t]), k) if t in lists else (0, k) for k, t in enumerate(phrase.tolist())]
    sizes.sort()
    if not sizes[0][0]:
        return np.zeros(0, np.int32)
    at = lists[int(phrase[sizes[0][1]])] - sizes[0][1]
    for size, k in sizes[1:]:
        if not len(at):
            break
        other = lists[int(phrase[k])]
        found = np.searchsorted(other, at + k)
        found[found == size] = 0
        at = at[other[found] == at + k]
    return at


def _within(at: np.ndarray, length: int, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matches inside one document, and the document of each."""
    at = at[at >= 0]
    doc = np.searchsorted(bases, at, "right") - 1
    inside = at + length <= bases[doc + 1]
    return at[inside], doc[inside]


def _phrases(items: list[tuple[str, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """The words of all items, place and length of each distinct phrase among them, and the items of the phrases: those of
    phrase p are ``owners[bounds[p] : bounds[p + 1]]``. Arrays only, as objects for each phrase would take many times the room."""
    words = np.concatenate([w for _, w in items])
    sizes = np.array([len(w) for _, w in items])
    first = np.cumsum(sizes) - sizes
    n = np.minimum(sizes, WINDOW)
    counts = sizes - n + 1
    owners = np.repeat(np.arange(len(items)), counts)
    starts = first[owners] + np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    names = np.zeros(len(owners), np.uint64)
    for length in np.unique(n).tolist():
        k = n[owners] == length
        names[k] = windows(words.view(np.uint64), length)[starts[k]]
    order = np.argsort(names, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], np.diff(names[order]) != 0]))
    return words, starts[order[new]], n[owners[order[new]]], owners[order], np.append(new, len(order))


def _search(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [item for item, _ in block.value]
        words, starts, lengths, owners, bounds = _phrases(block.value)
        wanted, code = np.unique(words, return_inverse=True)
        for doc_ids, bases, terms, firsts, places in _segment_rows(batches):
            spans: dict[int, list[tuple[int, int]]] = {}
            hit_items: dict[int, set[str]] = {}
            term = np.searchsorted(terms, wanted)
            there = (terms[np.minimum(term, len(terms) - 1)] == wanted) if len(terms) else np.zeros(len(wanted), bool)
            total = np.concatenate([[0], np.cumsum(there[code])])
            for p in np.flatnonzero(total[starts + lengths] - total[starts] == lengths).tolist():
                place = slice(starts[p], starts[p] + lengths[p])
                phrase = words[place]
                lists = {w: places[firsts[t] : firsts[t + 1]] for w, t in zip(phrase.tolist(), term[code[place]].tolist(), strict=True)}
                at = match_places(lists, phrase)
                if len(at):
                    names = {items[k] for k in owners[bounds[p] : bounds[p + 1]].tolist()}
                    for place, doc in zip(*_within(at, len(phrase), bases), strict=True):
                        spans.setdefault(int(doc), []).append((int(place), int(place) + len(phrase)))
                        hit_items.setdefault(int(doc), set()).update(names)
            docs = sorted(spans)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(doc_ids[d]) for d in docs], pa.int64()),
                    pa.array([[[a - int(bases[d]), b - int(bases[d])] for a, b in merged(spans[d])] for d in docs], pa.list_(pa.list_(pa.int64()))),
                    pa.array([sorted(hit_items[d]) for d in docs], pa.list_(pa.string())),
                ],
                ["doc_id", "spans", "items"],
            )

    return run


def _segment_rows(batches: Iterator[pa.RecordBatch]):
    """The columns of the index, one segment at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(batch.column(c)[k].values.to_numpy() for c in ("doc_ids", "bases", "terms", "starts", "places"))


def _open_segments(batches: Iterator[pa.RecordBatch], wanted: np.ndarray):
    """Documents, bases and the lists of the wanted terms, one segment at a time."""
    for ids, bases, terms, starts, places in _segment_rows(batches):
        at = np.searchsorted(terms, wanted)
        at = at[(at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == wanted)] if len(terms) else at[:0]
        yield ids, bases, {int(terms[t]): places[starts[t] : starts[t + 1]] for t in at.tolist()}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def phrase_hits(index: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``spans`` [from, to) in words, ``items`` (sorted) of every document with a phrase of an item.

    An item's phrases are its runs of ten words, or all its words if they are fewer.
    """
    spark = index.sparkSession
    words = items.select(F.col("item_id"), "text").filter("item_id is not null").mapInArrow(_phrase_words, "item_id string, words array<bigint>")
    found = []
    for block in _blocks(materialize(words, "benchmark-words")):
        shared = spark.sparkContext.broadcast(block)
        small_batches(spark, 4)  # a row is a whole segment
        hits = index.mapInArrow(_search(shared), "doc_id bigint, spans array<array<bigint>>, items array<string>")
        found.append(materialize(hits, "phrase-hits"))
        small_batches(spark)
    if not found:
        return spark.createDataFrame([], "doc_id bigint, spans array<array<bigint>>, items array<string>")
    hits = found[0]
    if len(found) == 1:
        return hits
    for more in found[1:]:
        hits = hits.unionByName(more)
    gathered = hits.groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<array<bigint>>").alias("out"))

    def step(acc, span):
        return F.struct(
            F.greatest(acc["end"], span[1]).alias("end"),
            F.when(span[1] <= acc["end"], acc["out"])
            .otherwise(F.concat(acc["out"], F.array(F.array(F.greatest(acc["end"], span[0]), span[1]))))
            .alias("out"),
        )

    return gathered.select(
        "doc_id", F.aggregate(F.array_sort("spans"), start, step)["out"].alias("spans"), F.array_sort(F.array_distinct("items")).alias("items")
    )


def near(lists: dict[int, np.ndarray], terms: np.ndarray, reach: int) -> np.ndarray:
    """Places of the rarest of ``terms`` that have every other one at most ``reach`` words away."""
    order = sorted(terms.tolist(), key=lambda t: len(lists.get(t, ())))
    at = lists.get(order[0], np.zeros(0, np.int32))
    for t in order[1:]:
        other = lists.get(t, np.zeros(0, np.int32))
        at = at[np.searchsorted(other, at - reach) < np.searchsorted(other, at + reach, "right")]
    return at


def _near(block, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        wanted = np.unique(np.concatenate([w for _, w in items]))
        for doc_ids, bases, lists in _open_segments(batches, wanted):
            rows = []
            for item, words in items:
                terms = np.unique(words)
                if any(t not in lists for t in terms.tolist()):
                    continue
                at = near(lists, terms, reach)
                doc = np.searchsorted(bases, at, "right") - 1
                for d, place in zip(doc.tolist(), at.tolist(), strict=True):
                    a, b = max(int(bases[d]), place - reach), min(int(bases[d + 1]), place + reach + 1)
                    ends = [(np.searchsorted(lists[t], a), np.searchsorted(lists[t], b)) for t in terms.tolist()]
                    if all(x < y for x, y in ends):  # in the same document
                        rows.append((int(doc_ids[d]), item, place - int(bases[d])))
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": d, "item_id": i, "place": p} for d, i, p in rows],
                pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("place", pa.int64())]),
            )

    return run


def proximity_hits(index: DataFrame, items: DataFrame, reach: int) -> DataFrame:
    """``doc_id``, ``item_id``, ``place`` (in words) where all words of an item stand within ``reach`` words of its rarest one."""
    spark = index.sparkSession
    words = items.select("item_id", "text").filter("item_id is not null").mapInArrow(_phrase_words, "item_id string, words array<bigint>")
    out = spark.createDataFrame([], "doc_id bigint, item_id string, place bigint")
    for block in _blocks(materialize(words, "benchmark-words")):
        found = index.mapInArrow(_near(spark.sparkContext.broadcast(block), reach), out.schema)
        small_batches(spark, 4)
        out = out.unionByName(materialize(found, "near-hits"))
        small_batches(spark)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans`` of every document.

    ``docs`` has unique doc_ids; further columns are ignored, rows without doc_id or item_id are left out. Repeated
    benchmark texts count as the items they are. A null or empty text has no words and is clean; so is everything if
    the benchmark is empty.
    """
    index = build_index(docs)
    hits = phrase_hits(index, benchmark)
    sized = index.select(F.posexplode("doc_ids").alias("k", "doc_id"), "bases").select(
        "doc_id", (F.element_at("bases", F.col("k") + 2) - F.element_at("bases", F.col("k") + 1)).cast("bigint").alias("n_words")
    )
    out = sized.join(hits, "doc_id", "left")
    size = F.aggregate(F.coalesce("spans", F.array()), F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        size.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (size > 0).alias("contaminated"),
        "spans",
    )


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any benchmark phrase stay; all columns stay.

    Rows without a doc_id are searched too, by their texts: they stay if their text is clean. An empty table gives no
    rows.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = phrase_hits(build_index(docs), benchmark)
    clean = docs.filter("doc_id is not null").join(found.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    nameless = docs.filter("doc_id is null")
    if nameless.isEmpty():
        return clean
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    bad = phrase_hits(build_index(nameless.select(text.alias("doc_id"), "text").dropDuplicates(["doc_id"])), benchmark)
    marked = nameless.withColumn("_text", text).join(bad.select(F.col("doc_id").alias("_text")), "_text", "left_anti")
    return clean.unionByName(marked.select(*docs.columns))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate(docs, benchmark).drop("spans")


QUERIES = {"op7_decontamination": op7_decontamination}
SQL = {
    "op7_decontamination": r"""
with doc_words as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents
),
item_words as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
),
item_windows as (
    select distinct item_id, least(len(w), 10) as n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as win
    from item_words where len(w) > 0
),
lengths as (select distinct n from item_windows),
places as (
    select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from doc_words, lengths where len(w) >= n
),
hits as (
    select p.doc_id, p.i, p.n, v.item_id
    from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win from places) p join item_windows v on v.n = p.n and v.win = p.win
),
hit_words as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id),
hit_items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
""",
}
