"""The streaming job: parse, validate, route, write."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from farelens.operators.rules import STREAM_COMPONENTS, UNKNOWN_ZONES
from farelens.session import materialize
from farelens.sources.schemas import select_to_schema
from farelens.sources.tables import replace_partitions, table_exists
from farelens.streaming.events import (
    CLEAN,
    DEAD,
    QUARANTINE,
    assign_route,
    derive_event_columns,
    parse_events,
    validate_events,
)
from farelens.streaming.storage import DAY, PARTITIONS, SCHEMAS, create_stream_tables, read_stored

# Kept per query and batch; what the watermark of the next batch follows from.
WATERMARKS = "_watermarks"
LATE = "late_event"
_QUERY_ID = "sql.streaming.queryId"


@dataclass(frozen=True)
class StreamOptions:
    """Settings of the job. ``dedupe``: None, ``table`` or ``watermark`` (see :func:`run_stream`)."""

    unknown_zones: Iterable[int] = UNKNOWN_ZONES
    components: Iterable[str] = STREAM_COMPONENTS
    fill_labels: bool = False
    dedupe: str | None = None
    watermark: str = "1 day"
    trigger: dict = field(default_factory=lambda: {"processingTime": "1 minute"})


def _usable() -> Column:
    return (F.col("route") != DEAD) & F.col("event_id").isNotNull() & F.col("event_time").isNotNull()


def split_late(batch: DataFrame, query_id: str, batch_id: int, out_dir: str, delay: str) -> DataFrame:
    """Send events older than the watermark to the dead letters, as ``late_event``.

    The watermark is the newest event time of the batches before, less ``delay``. That time is stored with each batch,
    so a replay finds the watermark it had, and a batch looks at one row of the one before it.
    """
    spark = batch.sparkSession
    state = lambda k: f"{out_dir}/{WATERMARKS}/query_id={query_id}/batch_id={k}"
    before = None
    if batch_id and table_exists(spark, state(batch_id - 1)):
        before = spark.read.schema("newest timestamp").parquet(state(batch_id - 1)).first()["newest"]
    newest = batch.filter(_usable()).agg(F.greatest(F.max("event_time"), F.lit(before).cast("timestamp")).alias("newest"))
    newest.write.mode("overwrite").parquet(state(batch_id))
    if before is None:
        return batch
    late = _usable() & (F.col("event_time") < F.lit(before).cast("timestamp") - F.expr(f"interval {delay}"))
    return batch.withColumns({"error": F.when(late, LATE).otherwise(F.col("error")), "route": F.when(late, DEAD).otherwise(F.col("route"))})


def drop_repeats(batch: DataFrame, query_id: str, batch_id: int, out_dir: str) -> DataFrame:
    """Drop events of this micro-batch that the tables hold already, and repeats within the batch.

    Exact for any lateness: the stored days that occur in the batch are read, by their folders, and no others. A repeat
    carries the same event time. Ids are counted first; only the rows of repeated ids are compared, and the least row
    of an id is kept: an aggregation, so a much-repeated id folds before the shuffle. Rows of the batch's own number are
    ignored, so a replay gives the same result.
    """
    spark = batch.sparkSession
    columns, usable = batch.columns, batch.filter(_usable())
    days = [r[0] for r in usable.select(F.date_format("event_time", "yyyy-MM-dd")).distinct().collect()]
    repeated = usable.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("event_id")
    repeated = materialize(repeated, "repeated-events")
    least = usable.join(repeated, "event_id", "left_semi").groupBy("event_id").agg(F.min(F.struct(*columns)).alias("_row"))
    least = materialize(least.select("_row.*"), "least-events")
    keyed = usable.join(repeated, "event_id", "left_anti").select(*columns).unionByName(least)
    ids = []
    for table in (CLEAN, QUARANTINE):
        stored = read_stored(spark, out_dir, table, days).filter((F.col("query_id") != query_id) | (F.col("batch_id") != batch_id))
        ids.append(stored.select("event_id"))
    keyed = keyed.join(ids[0].unionByName(ids[1]), "event_id", "left_anti")
    return keyed.select(*columns).unionByName(batch.filter(~_usable()))


def table_rows(routed: DataFrame, table: str, options: StreamOptions) -> DataFrame:
    """The rows of one table, in its schema; only clean rows get derived columns."""
    rows = routed.filter(F.col("route") == table)
    if table == CLEAN:
        rows = derive_event_columns(rows, options.fill_labels)
    if table != DEAD:
        rows = rows.withColumns({"_loaded_at": F.current_timestamp(), "_data_source": F.lit("streaming")})
    return select_to_schema(rows, SCHEMAS[table])


def write_routed(routed: DataFrame, query_id: str, batch_id: int, out_dir: str, options: StreamOptions) -> None:
    """Write one micro-batch to the three tables; writing it again replaces its own partitions."""
    if not options.dedupe:
        # Only dead letters keep their text, so the text of the others need not be cached.
        routed = routed.withColumn("value", F.when(F.col("route") == DEAD, F.col("value")))
    routed = routed.persist()
    try:
        judged = kept = routed
        if options.dedupe == "watermark":
            judged = kept = split_late(routed, query_id, batch_id, out_dir, options.watermark)
        if options.dedupe:
            kept = drop_repeats(judged, query_id, batch_id, out_dir)
        stamp = {"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("bigint")}
        for table in SCHEMAS:
            # Dead letters are never dropped as repeats.
            rows = table_rows(judged if table == DEAD else kept, table, options).withColumns(stamp)
            by_day = DAY in PARTITIONS[table]
            if by_day:
                rows = rows.withColumn("event_date", F.to_date("event_time"))
            folders = [f.name for f in PARTITIONS[table]]
            replace_partitions(rows, f"{out_dir}/{table}", *folders, rebalance=by_day)
    finally:
        routed.unpersist()


def run_stream(
    messages: DataFrame, out_dir: str, checkpoint: str, options: StreamOptions | None = None
) -> StreamingQuery:
    """Start the job on a stream of messages and return its query.

    ``dedupe`` is off by default. ``table`` compares with all stored days that occur in a batch. ``watermark`` does so
    within ``options.watermark`` of the newest event only, so that the days read for a batch are bounded; older events
    become dead letters with the reason ``late_event``. Neither loses a message.
    """
    options = options or StreamOptions()
    if options.dedupe not in (None, "table", "watermark"):
        raise ValueError(f"unknown dedupe mode {options.dedupe!r}")
    spark = messages.sparkSession
    create_stream_tables(spark, out_dir)
    routed = assign_route(validate_events(parse_events(messages), options.unknown_zones, options.components))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept in the checkpoint: the same query has the same id after a restart.
        query_id = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        write_routed(batch, query_id, batch_id, out_dir, options)

    return (
        routed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**options.trigger)
        .start()
    )
