"""Parquet tables: period replacement, upsert and full refresh.

A table is a folder with a declared schema. Writes replace whole folders (a period, a batch or the
table), so running a job again gives the same table. Partitioned upserts go to tables with versions
(:mod:`farelens.sources.versions`); :func:`read_table` reads both kinds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelens.session import materialize
from farelens.sources import versions
from farelens.sources.versions import file_system, is_versioned, read_versions

LOAD_PERIOD = "load_period"
CLUSTER_COLUMNS = ("PULocationID", "DOLocationID")
#: Hashes of keys that are compared by name; if more of them repeat, all keys are compared.
MOST_HASHES = 1_000


class DuplicateKeyError(Exception):
    """The source of an upsert holds a key more than once."""


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).schema  # noqa: B018 - resolving the path is the test
        return True
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Create an empty table if there is none."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read with the declared schema: an empty table is as good as a full one."""
    if is_versioned(spark, path):
        return read_versions(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def write_mart(df: DataFrame, path: str) -> None:
    """Replace the whole table; it is there, old or new, at every moment but between two renames."""
    exchange_table(df, path)


def replace_period(
    df: DataFrame,
    path: str,
    period: str,
    partition_cols: Sequence[str] = (),
    cluster_by: Sequence[str] = CLUSTER_COLUMNS,
) -> None:
    """Replace what the load of ``period`` wrote before; other loads stay.

    Rows are kept by the period of the load, not of the pickup, so late rows in the file do not pile up
    when it is loaded again; an empty load empties the period. Each task sorts its own rows by
    location: the Parquet statistics then allow skipping, without a shuffle, whatever the skew.
    """
    sort_by = [*partition_cols, *cluster_by]
    writer = (df.sortWithinPartitions(*sort_by) if sort_by else df).write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(f"{path}/{LOAD_PERIOD}={period}")


def replace_partitions(df: DataFrame, path: str, *partition_cols: str, rebalance: bool = True) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Rows are rebalanced by the first partition column, so that not every task writes a file into
    every folder; AQE splits a large folder over many tasks again. Rows that fall into one folder
    need no rebalancing.
    """
    if rebalance:
        df = df.hint("rebalance", partition_cols[0])
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def upsert(source: DataFrame, path: str, keys: Sequence[str], partition_col: str | None = None) -> None:
    """Merge on ``keys``: matching rows are replaced, new ones are added, others stay.

    With a ``partition_col``, which must follow from the keys, the source is written once, as a new version, and its
    keys are tested there. Only partitions that occur in it and in the table are read and written again, merged; one
    rename of a manifest commits all of them. Without one, the merged rows are written beside the table, which is then
    exchanged by renaming. A run that is cut short anywhere leaves the old table or the new one, and
    can be repeated. A key twice in the source is refused; NULL keys match nothing.
    """
    spark = source.sparkSession
    if partition_col:
        _upsert_version(source, path, list(keys), partition_col)
        return
    recover_table(spark, path)
    source = materialize(source, "upsert-source")
    refuse_repeats(source, keys)
    merged = source
    if table_exists(spark, path):
        target = spark.read.schema(source.schema).parquet(path)
        merged = target.join(source.select(*keys), list(keys), "left_anti").select(*source.columns).unionByName(source)
    exchange_table(merged, path)


def _upsert_version(source: DataFrame, path: str, keys: list[str], partition_col: str) -> None:
    spark, schema = source.sparkSession, _target_schema(source, partition_col)
    if partition_col in keys:
        source = materialize(source, "upsert-source")  # folder names do not tell empty text from NULL
    number, manifest = versions.read_manifest(spark, path)
    version, written = versions.write_version(source, path, partition_col)
    new = dict.fromkeys(written, version)
    keyed = source if partition_col in keys else versions.read_folders(spark, path, schema, new)
    try:
        refuse_repeats(keyed, keys)
    except DuplicateKeyError:
        fs, folder = file_system(spark, path)
        fs.delete(folder(f"{path}/version={version}"), True)
        raise
    met = {f: manifest[f] for f in written if f in manifest}
    if met:
        kept = versions.read_folders(spark, path, schema, met).join(keyed.select(*keys), keys, "left_anti").select(*schema.fieldNames())
        merged = kept.unionByName(versions.read_folders(spark, path, schema, {f: version for f in met}))
        new |= dict.fromkeys(met, versions.write_version(merged, path, partition_col, rebalance=len(met) > 1)[0])
    versions.commit(spark, path, number, manifest | new)


def refuse_repeats(source: DataFrame, keys: Sequence[str]) -> None:
    """Fail if a key without NULLs occurs more than once.

    Hashes are counted first, so that keys of long text are not shuffled; keys are compared only where a hash repeats.
    """
    hashed = source.dropna(subset=list(keys)).withColumn("_hash", F.xxhash64(*keys))
    repeated = [r[0] for r in hashed.groupBy("_hash").count().filter("count > 1").select("_hash").take(MOST_HASHES)]
    if not repeated:
        return
    compared = hashed.filter(F.col("_hash").isin(repeated)) if len(repeated) < MOST_HASHES else hashed
    example = compared.groupBy(*keys).count().filter("count > 1").first()
    if example is not None:
        raise DuplicateKeyError(f"key {example.asDict()} is not unique in the source")


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish or undo an exchange of the table that was cut short."""
    fs, folder = file_system(spark, path)
    old = folder(f"{path}.old")
    if fs.exists(old):
        if fs.exists(folder(path)):
            fs.delete(old, True)  # the new table was in place already
        else:
            fs.rename(old, folder(path))


def exchange_table(df: DataFrame, path: str) -> None:
    """Replace the table by ``df``, which may read it: written beside it first, then exchanged by two renames."""
    spark = df.sparkSession
    recover_table(spark, path)
    df.write.mode("overwrite").parquet(f"{path}.next")
    fs, folder = file_system(spark, path)
    if fs.exists(folder(path)) and not fs.rename(folder(path), folder(f"{path}.old")):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(folder(f"{path}.next"), folder(path)):
        raise OSError(f"{path}.next could not take the place of {path}")
    fs.delete(folder(f"{path}.old"), True)


def _target_schema(source: DataFrame, partition_col: str) -> StructType:
    fields = [f for f in source.schema.fields if f.name != partition_col]
    return StructType([*fields, *[f for f in source.schema.fields if f.name == partition_col]])
