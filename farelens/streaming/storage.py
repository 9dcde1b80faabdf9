"""How stream tables are stored, read and compacted.

Micro-batches write small folders: by day, query and batch (dead letters, which have no event day, by query and batch).
A replayed batch replaces exactly its own folders. Compaction rewrites the rows of older batches of a day into a table
with versions beside them, ``<table>_compacted``. Its manifest notes up to which batch of each query a day is covered;
readers leave these batches' own folders out, so the one rename of the manifest moves all rows at once, and the covered
folders can be removed at leisure. The newest batch of a query may still be replayed and is never covered: Spark begins
a batch only after the one before it is in the checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from farelens.session import empty_frame
from farelens.sources.schemas import DEAD_LETTER, STREAM_CLEAN, STREAM_QUARANTINE
from farelens.sources.tables import ensure_table
from farelens.sources.versions import (
    file_system,
    folder_name,
    read_manifest,
    read_notes,
    read_versions,
    remove_unreferenced,
    replace_folders,
)
from farelens.streaming.events import CLEAN, DEAD, QUARANTINE

SCHEMAS = {CLEAN: STREAM_CLEAN, QUARANTINE: STREAM_QUARANTINE, DEAD: DEAD_LETTER}
WRITER = [StructField("query_id", StringType()), StructField("batch_id", LongType())]
DAY = StructField("event_date", DateType())
PARTITIONS = {CLEAN: [DAY, *WRITER], QUARANTINE: [DAY, *WRITER], DEAD: WRITER}
#: Batches of one query whose dead letters are compacted together.
BATCHES_TOGETHER = 1_000
#: Compactions add their rows to a part until it has so many versions; then it is written anew as one.
MOST_VERSIONS = 8


def stored_schema(table: str) -> StructType:
    """Columns as stored; nothing is declared non-NULL when reading files."""
    fields = [StructField(f.name, f.dataType) for f in SCHEMAS[table].fields]
    return StructType([*fields, *PARTITIONS[table]])


def _group(table: str) -> Column:
    """What is compacted together, as text: the day, or a run of a query's batches."""
    if DAY in PARTITIONS[table]:
        return F.date_format("event_date", "yyyy-MM-dd")
    return F.concat_ws("-", "query_id", F.floor(F.col("batch_id") / BATCHES_TOGETHER).cast("string"))


def _compacted_schema(table: str) -> StructType:
    return StructType([*stored_schema(table).fields, StructField("part", StringType())])


def create_stream_tables(spark: SparkSession, out_dir: str) -> None:
    for table in SCHEMAS:
        ensure_table(spark, f"{out_dir}/{table}", SCHEMAS[table])


def _covered(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """``part``, ``query``, ``upto``: the batches that compaction has taken over; as many rows as parts have queries."""
    notes = read_notes(spark, f"{out_dir}/{table}_compacted")
    rows = [(folder.split("=", 1)[1], query, upto) for folder, note in notes.items() for query, upto in json.loads(note).items()]
    schema = StructType.fromDDL("part string, query string, upto bigint")
    return spark.createDataFrame(rows, schema) if rows else empty_frame(spark, schema)


def _plain(spark: SparkSession, out_dir: str, table: str, days: Iterable[str] | None) -> DataFrame:
    """Rows of the batches' own folders, of some days or all, with their part; those taken over are still there."""
    root = f"{out_dir}/{table}"
    reader = spark.read.schema(stored_schema(table)).option("basePath", root)
    if days is not None:
        fs, folder = file_system(spark, root)
        paths = [p for p in (f"{root}/{folder_name('event_date', d)}" for d in days) if fs.exists(folder(p))]
        rows = reader.parquet(*paths) if paths else empty_frame(spark, stored_schema(table))
    else:
        rows = reader.parquet(root)
    return rows.withColumn("part", _group(table))


def read_stored(spark: SparkSession, out_dir: str, table: str, days: Iterable[str] | None = None) -> DataFrame:
    """A stream table with its storage columns; of ``days`` (texts), only their folders are listed and read."""
    days = None if days is None else sorted(set(days))
    plain, covered = _plain(spark, out_dir, table, days), _covered(spark, out_dir, table)
    joined = plain.join(F.broadcast(covered.withColumnRenamed("part", "of")), (F.col("part") == F.col("of")) & (F.col("query_id") == F.col("query")), "left")
    own = joined.filter("upto is null or batch_id > upto").select(*stored_schema(table).fieldNames())
    folders = None if days is None else [folder_name("part", d) for d in days]
    compacted = read_versions(spark, f"{out_dir}/{table}_compacted", _compacted_schema(table), folders).drop("part")
    return own.unionByName(compacted)


def read_stream_table(spark: SparkSession, out_dir: str, table: str, days: Iterable[str] | None = None) -> DataFrame:
    """A stream table, or some days of it, without its storage columns."""
    return read_stored(spark, out_dir, table, days).select(*SCHEMAS[table].fieldNames())


def compact_stream(spark: SparkSession, out_dir: str, table: str) -> int:
    """Rewrite the rows of all batches but each query's newest, by part; the number of parts written to.

    Parts without a batch that is not covered yet are left alone. Rows compacted before stay where they are, but for
    parts of MOST_VERSIONS versions. Cut short anywhere, the table reads as before.
    """
    remove_covered(spark, out_dir, table)
    plain = _plain(spark, out_dir, table, None)
    newest = plain.groupBy("query_id").agg(F.max("batch_id").alias("newest"))
    older = plain.join(F.broadcast(newest), "query_id").filter("batch_id < newest").drop("newest")
    # One row for each part and query.
    found = older.groupBy("part", "query_id").agg(F.max("batch_id").alias("upto")).collect()
    if not found:
        return 0
    path, notes = f"{out_dir}/{table}_compacted", {}
    before = read_notes(spark, path)
    for r in found:
        folder = folder_name("part", r["part"])
        notes.setdefault(folder, json.loads(before.get(folder, "{}")))[r["query_id"]] = r["upto"]
    columns = _compacted_schema(table).fieldNames()
    _, manifest = read_manifest(spark, path)
    full = [f for f in notes if manifest.get(f, "").count(",") + 1 >= MOST_VERSIONS]
    known = read_versions(spark, path, _compacted_schema(table), full)
    rows = older.select(*columns).unionByName(known.select(*columns))
    replace_folders(rows, path, "part", notes, notes={f: json.dumps(n) for f, n in notes.items()}, added=notes.keys() - set(full))
    return len(notes)


def remove_covered(spark: SparkSession, out_dir: str, table: str) -> int:
    """Delete the folders of batches that compaction has taken over, and old versions; the number of folders deleted.

    May be repeated, and cut short. Readers that began before the compaction should have ended.
    """
    root = f"{out_dir}/{table}"
    folders = _plain(spark, out_dir, table, None).select("part", *[f.name for f in PARTITIONS[table]]).distinct()
    covered = _covered(spark, out_dir, table).withColumnRenamed("part", "of")
    done = folders.join(F.broadcast(covered), (F.col("part") == F.col("of")) & (F.col("query_id") == F.col("query")) & (F.col("batch_id") <= F.col("upto")))
    fs, folder = file_system(spark, root)
    names = ["/".join(folder_name(f.name, r[f.name]) for f in PARTITIONS[table]) for r in done.toLocalIterator()]
    for name in names:
        fs.delete(folder(f"{root}/{name}"), True)
    remove_unreferenced(spark, f"{root}_compacted")
    return len(names)
