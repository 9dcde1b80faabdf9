"""Line dedup: repeated runs of lines by a suffix array over line ids, built by distributed prefix doubling.

A suffix is a line of a document and all that follow it there. Its name of level k stands for its first 2**k lines:
the name of level 0 is the line's id, and the name of level k + 1 joins the names of level k of the line and of the
line 2**k further on. Suffixes of one document lie in one row, so doubling needs no shuffle; only the search for
names that occur again does, and it sends names, not lines. Ordered by their names of all levels, suffixes stand so
that those with a common prefix of 2**k lines are neighbours: such a stretch is an interval of the common-prefix
array. The first suffix of an interval, by document and line, is the original, the others are later copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelens.session import materialize, spread

MIN_LINES = 2
#: Words of a line that the query and the pipeline's stage count as a run by itself, at least.
LONG_LINE_WORDS = 20


def _ids(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.xxhash64(x, F.length(x)))


def _doubled(names: Column, step: Column) -> Column:
    """Names of twice the length, for every line that has another one ``step`` lines further on."""
    n = F.greatest(F.size(names) - step, F.lit(0))
    return F.transform(F.slice(names, 1, n), lambda x, i: F.xxhash64(x, F.element_at(names, i + step + 1)))


def _joined(names: Column, step: int) -> Column:
    if step == 0:
        return names
    first = F.slice(names, F.lit(1), F.greatest(F.size(names) - step, F.lit(0)))
    return F.zip_with(first, F.slice(names, F.lit(step + 1), F.size(first)), lambda a, b: F.xxhash64(a, b))


def _line_numbers(lines: Column) -> Column:
    """Numbers of the lines that are not blank."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.element_at(lines, i + 1).rlike(r"[^\x20\x09-\x0D]"))


def _once(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once a row.

    A column used in a lambda may be replaced by its expression when the optimizer moves a filter or merges
    projections; it is then computed anew for every element. A variable of a lambda cannot be replaced.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _n_words(line: Column) -> Column:
    return F.size(F.regexp_extract_all(line, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))


def line_table(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """``doc_id`` and ``names`` (ids of the lines that are not blank) of each document.

    A line ends at a line feed; ids are 64-bit hashes of whole lines, blank lines (white space only) have none.
    With ``min_words`` also ``long``: numbers, among ``names``, of the lines of so many words or more.
    """
    kept = _once(
        F.split(F.coalesce("text", F.lit("")), "\n", -1),
        lambda lines: F.transform(_line_numbers(lines), lambda i: F.element_at(lines, i + 1)),
    )
    docs = docs.filter("doc_id is not null")
    if min_words is None:
        return docs.select("doc_id", _ids(kept).alias("names"))

    def numbers(lines):
        return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: _n_words(F.element_at(lines, i + 1)) >= min_words)

    both = _once(kept, lambda lines: F.struct(_ids(lines).alias("names"), F.when(F.size(lines) > 0, numbers(lines)).otherwise(F.array().cast("array<int>")).alias("long")))
    return docs.select("doc_id", both.alias("_both")).select("doc_id", "_both.names", "_both.long")


def window_names(names: Column, length: int) -> Column:
    """Names of all runs of ``length`` lines: two names of the largest power of two that fits, one at either end."""
    level = 0
    while 2 << level <= length:
        names = _joined(names, 1 << level)
        level += 1
    return _joined(names, length - (1 << level))


def _repeats(names: DataFrame) -> DataFrame:
    """``name``, ``first_doc``, ``first_line`` of names that occur more than once; counted before the shuffle."""
    found = names.groupBy("name").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    return found.filter("n > 1").select("name", F.col("first.doc_id").alias("first_doc"), F.col("first.line").alias("first_line"), "n")


def suffix_array(docs: DataFrame) -> DataFrame:
    """The suffixes that begin with a repeated line: ``doc_id``, ``line`` (among those not blank), ``levels``, ``names``.

    ``levels`` is the number of levels at which the suffix's name occurs elsewhere too: it shares at least its first
    2**(levels - 1) lines with another suffix. Order by ``names`` for the suffix array; within it, the suffixes with
    equal first k + 1 names are an interval of common prefixes of 2**k lines. Each round doubles the length and goes
    on with suffixes that are still repeated; it ends when none is.
    """
    rows = line_table(docs).select("doc_id", "names")
    active, level, out = rows, 0, None
    while True:
        current = materialize(active.filter(F.size("names") > 0), "suffix-names")
        exploded = current.select("doc_id", F.posexplode("names").alias("line", "name"))
        again = materialize(exploded.join(_repeats(exploded).select("name"), "name"), "suffix-repeats")
        if again.isEmpty():
            break
        part = again.select("doc_id", "line", F.struct(F.lit(level).alias("level"), "name").alias("entry"))
        out = part if out is None else out.unionByName(part)
        live = again.select("doc_id").distinct()
        active = current.join(live, "doc_id", "left_semi").withColumn("names", _doubled(F.col("names"), F.lit(1 << level)))
        level += 1
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, line int, levels int, names array<bigint>")
    gathered = out.groupBy("doc_id", "line").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    return gathered.select("doc_id", "line", F.size("entries").alias("levels"), F.col("entries.name").alias("names"))


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """Suffixes of which a prefix stands earlier: ``doc_id``, ``line``, ``width`` (lines of the prefix), ``first_doc``, ``first_line``.

    Prefix doubling: the names of level 0 stand for ``min_lines`` lines, those of each further level for twice as many,
    and a round goes on with the documents that have a repeated name. Suffixes of equal names are an interval of common
    prefixes; all but its first one, by document and line, are later copies of that. With ``min_words`` single lines of
    so many words or more are an interval of their own.
    """
    table = materialize(line_table(docs, min_words), "line-names")
    active = table.select("doc_id", window_names(F.col("names"), min_lines).alias("names"))
    rows, out, width = None, None, min_lines
    if min_words is not None and min_lines > 1:
        single = table.select("doc_id", "names", F.explode("long").alias("line"))
        rows = single.select("doc_id", "line", F.element_at("names", F.col("line") + 1).alias("name"), F.lit(1).alias("width"))
    while True:
        windows = active.select("doc_id", F.posexplode("names").alias("line", "name")).withColumn("width", F.lit(width))
        windows = windows if rows is None else windows.unionByName(rows)
        windows, rows = materialize(windows, "line-windows"), None
        repeated = windows.join(_repeats(windows).drop("n"), "name").drop("name")
        repeated = materialize(repeated, "line-intervals")
        if repeated.isEmpty():
            break
        later = repeated.filter("not (doc_id = first_doc and line = first_line)")
        out = later if out is None else out.unionByName(later)
        live = repeated.filter(F.col("width") == width).select("doc_id").distinct()
        names = _joined(F.col("names"), width)
        active = materialize(active.join(live, "doc_id", "left_semi").withColumn("names", names).filter(F.size("names") > 0), "line-names")
        width *= 2
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, line int, width int, first_doc bigint, first_line int")
    return out


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """``doc_id``, ``doomed`` (numbers of lines to delete), ``runs`` of documents with later copies of line runs.

    A run is a stretch of lines that are not blank, at least ``min_lines`` of them, that stands as a whole at one earlier
    place (by doc_id, then line) and is part of no longer one; with ``min_words`` also one line of so many words or
    more. Of each suffix the longest prefix counts that stands earlier, among those of ``min_lines`` times a power of two
    lines; prefixes that touch and stand at one place without a shift make up a run. So parts that stand earlier still
    elsewhere can be runs of their own, which overlap. ``runs`` are structs of ``start`` and ``length`` in such lines, with
    ``from_doc`` and ``from_line`` of the earlier place.
    """
    found = later_copies(docs, min_lines, min_words)
    longest = found.groupBy("doc_id", "line").agg(F.max_by(F.struct("width", "first_doc", "first_line"), "width").alias("p"))
    placed = longest.select("doc_id", "line", (F.col("line") + F.col("p.width")).alias("end"), F.col("p.first_doc").alias("from_doc"), (F.col("p.first_line") - F.col("line")).alias("shift"))
    # All windows are within one document, which is one text.
    place = Window.partitionBy("doc_id", "from_doc", "shift").orderBy("line")
    before = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    islands = placed.withColumn("new", F.coalesce((F.col("line") > before).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("doc_id", "from_doc", "shift", "island").agg(F.min("line").alias("start"), F.max("end").alias("end"))
    inside = F.max("end").over(Window.partitionBy("doc_id").orderBy("start", F.desc("end"), "from_doc", "shift").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("inside", F.coalesce(inside >= F.col("end"), F.lit(False))).filter("not inside")
    run = F.struct("start", (F.col("end") - F.col("start")).alias("length"), "from_doc", (F.col("start") + F.col("shift")).alias("from_line"))
    listed = runs.groupBy("doc_id").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    lines = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["length"] - 1))))
    return listed.select("doc_id", lines.alias("doomed"), "runs")


def drop_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``, and ``n_lines``, ``n_deleted``, ``runs``.

    All columns stay; extra ones are not looked at, and one named like a new column is replaced. Blank lines are
    neither compared nor deleted, except that a text of which no other line is left becomes empty. A null text stays
    null with no lines; a row without doc_id stays as it is. Of equal documents the one with the smallest id stays
    whole. Texts are read whole, and a line is never cut. ``min_words`` as in ``repeated_runs``; without it a line
    that stands between different neighbours is never cut, however long.
    """
    docs = spread(docs, docs)
    found = materialize(repeated_runs(docs, min_lines, min_words), "line-runs").withColumnRenamed("doc_id", "_doc").withColumnRenamed("runs", "_runs")
    base = docs.drop("n_lines", "n_deleted", "runs")
    # Merged at every size: a broadcast while few documents have copies would only hide what the join costs.
    joined = base.join(found.hint("merge"), base["doc_id"] == found["_doc"], "left")

    def cut(lines, at):
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        left = F.array_except(every, F.transform("doomed", lambda k: F.element_at(at, k + 1)))
        text = F.array_join(F.transform(left, lambda k: F.element_at(lines, k + 1)), "\n")
        text = F.when(F.size("doomed") == F.size(at), F.lit("")).otherwise(text)
        return F.struct(F.size(at).alias("n_lines"), F.when(F.col("_doc").isNotNull(), text).alias("text"))

    cut_text = _once(F.split(F.col("text"), "\n", -1), lambda lines: _once(_line_numbers(lines), lambda at: cut(lines, at)))
    kept = F.when(F.col("_doc").isNull(), F.col("text")).otherwise(F.col("_cut.text"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.col("_cut.n_lines"))
    return joined.withColumn("_cut", cut_text).select(
        *[kept.alias("text") if c == "text" else F.col(c) for c in base.columns],
        n_lines.cast("bigint").alias("n_lines"),
        F.when(F.col("_doc").isNull(), 0).otherwise(F.size("doomed")).cast("bigint").alias("n_deleted"),
        F.coalesce("_runs", F.array().cast("array<struct<start:int,length:int,from_doc:bigint,from_line:int>>")).alias("runs"),
    )


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: later copies of line runs are cut; a document of which nothing is left goes. n_chars follows the text.

    A line of LONG_LINE_WORDS words or more is a run by itself; shorter ones go with their neighbours only.
    """
    out = drop_repeated_lines(docs, min_words=LONG_LINE_WORDS).filter("n_deleted = 0 or text <> ''")
    return out.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document, with the numbers of its lines and of those deleted."""
    out = drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_words=LONG_LINE_WORDS)
    return out.select("doc_id", "text", "n_lines", "n_deleted")


QUERIES = {"op9_line_dedup": op9_line_dedup}
SQL = {
    "op9_line_dedup": r"""
with lines as (
    select doc_id, k, line, row_number() over (partition by doc_id order by k) as r
    from (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as k from documents)
    where regexp_matches(line, '[^\x20\x09-\x0D]')
),
pairs as (select a.doc_id, a.r, a.line as l1, b.line as l2 from lines a join lines b on a.doc_id = b.doc_id and b.r = a.r + 1),
numbered as (select doc_id, r, row_number() over (partition by l1, l2 order by doc_id, r) as copy from pairs),
singles as (
    select doc_id, r, row_number() over (partition by line order by doc_id, r) as copy from lines
    where len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 20
),
doomed as (
    select doc_id, r from numbered where copy > 1 union select doc_id, r + 1 from numbered where copy > 1
    union select doc_id, r from singles where copy > 1
),
gone as (select doc_id, list(k) as ks, count(*) as n_deleted from lines join doomed using (doc_id, r) group by doc_id),
sizes as (select doc_id, count(*) as n_lines from lines group by doc_id)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_deleted, 0) as n_deleted,
    case when ks is null then text when n_deleted = n_lines then ''
        else array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not list_contains(ks, i - 1)), chr(10)) end as text
from documents left join sizes using (doc_id) left join gone using (doc_id)
""",
}
