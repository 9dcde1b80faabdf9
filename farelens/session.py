"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Settings a cluster run should start from. Shuffles begin with many partitions and AQE merges
# the small ones; skewed join partitions are split at run time.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}

# A dimension of at most this many rows may be broadcast.
MAX_BROADCAST_ROWS = 200_000


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("farelens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in CLUSTER_CONF.items():
        if not key.endswith("initialPartitionNum"):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Trip times are UTC instants; hours and dates are taken in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a fresh temporary folder; a cluster session is refused,
    since a folder on one machine would not survive there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    # The setting cannot change within a session; its context remembers the folder instead.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="farelens-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, *partition_cols: str, row_group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, gives every consumer the same rows, and lets the optimizer see the real size. Writers hold a whole
    row group, and readers a whole one of few rows; ``row_group_bytes`` bounds it, to one row at least, where rows are large.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
        for check in ("page", "block"):  # else sizes are looked at every hundred rows
            writer = writer.option(f"parquet.{check}.size.row.check.min", 1).option(f"parquet.{check}.size.row.check.max", 1)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """A table without rows; needs no Python tasks, and Spark plans joins and unions with it away."""
    return spark.range(1).limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def broadcast_if_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` is small; otherwise leave the join to Spark."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """Use all cores for rows that come from a ``source`` scan with fewer partitions than cores.

    A small file is one task however many cores there are. A large scan has more partitions than
    there are cores, and ``df`` is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if source.rdd.getNumPartitions() < cores else df
