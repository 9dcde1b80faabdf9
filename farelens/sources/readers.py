"""Readers for trips, zones and event messages."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamReader
from pyspark.sql.types import StructType

from farelens.sources.schemas import RAW_TRIP, RAW_ZONE, select_to_schema


#: Spark's condition where the schemas of files do not merge.
UNMERGEABLE = "[CANNOT_MERGE_SCHEMAS]"


def schema_groups(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by schema (as JSON) under which they can be read together.

    Spark merges the footers of many files in one job on the executors. Files whose types do not merge are halved, so
    that a few changes of schema in a long row of months take a few jobs for each change, not one for each file.
    """
    try:
        return {spark.read.option("mergeSchema", True).parquet(*files).schema.json(): list(files)}
    except Exception as err:  # the executors' refusal comes as a plain Java error
        if len(files) == 1 or UNMERGEABLE not in str(err):
            raise
    groups: dict[str, list[str]] = {}
    for half in (files[: len(files) // 2], files[len(files) // 2 :]):
        for schema, some in schema_groups(spark, half).items():
            groups.setdefault(schema, []).extend(some)
    return groups


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Monthly Parquet files or folders of them, conformed to the 21-column raw schema.

    Months differ: a later one has a column more, or whole numbers where another has floating ones. Files whose
    schemas merge are read together; each group is conformed before they are united, so that no column of any file
    is lost.
    """
    files = sorted(spark.read.parquet(*paths).inputFiles())
    if not files:
        return select_to_schema(spark.read.parquet(*paths), RAW_TRIP)
    parts = [
        select_to_schema(spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*some), RAW_TRIP)
        for schema, some in schema_groups(spark, files).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_schemas(spark: SparkSession, *paths: str) -> DataFrame:
    """``schema`` (as DDL) and ``n_files`` of the groups in which the files of a load are read: its entry in a catalogue."""
    groups = schema_groups(spark, sorted(spark.read.parquet(*paths).inputFiles()))
    rows = [(StructType.fromJson(json.loads(schema)).simpleString(), len(files)) for schema, files in groups.items()]
    return spark.createDataFrame(sorted(rows), "schema string, n_files bigint")


def read_trips_dir(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of a folder as one frame; fails if there are none."""
    try:
        return read_trips(spark, folder)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no Parquet files in {folder}") from err
        raise


def read_zones(spark: SparkSession, path: str, null_value: str | None = None) -> DataFrame:
    """The zone lookup CSV with declared types; ``null_value`` names a text to read as NULL."""
    reader = spark.read.schema(RAW_ZONE).option("header", True)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON messages, one per line, from a folder that producers add files to."""
    reader: DataStreamReader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """JSON messages from a broker topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
        .selectExpr("cast(value as string) as value")
    )
