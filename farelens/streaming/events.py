"""Parse, validate and derive trip events; the same columns work on a stream and on a batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from farelens.functions import derive
from farelens.operators.rules import STREAM_COMPONENTS, UNKNOWN_ZONES, flag_events, validity_rules
from farelens.sources.schemas import EVENT

_CORRUPT = "_corrupt"


def _message_schema() -> StructType:
    """Whole numbers arrive as 1 or as 1.0, so they are read as doubles; times arrive as text."""
    kinds = {LongType(): DoubleType(), TimestampType(): StringType()}
    fields = [StructField(f.name, kinds.get(f.dataType, f.dataType)) for f in EVENT.fields]
    return StructType([*fields, StructField(_CORRUPT, StringType())])


MESSAGE = _message_schema()


def parse_events(messages: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Messages (``value`` text) to event columns plus ``value`` and ``error``.

    ``ingestion_time`` is the time of processing. ``error`` is NULL for a usable event; otherwise the
    event columns are not to be trusted: not UTF-8, not a JSON object, a field of the wrong type, a
    fraction where a whole number belongs, or an unreadable time.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    e = F.from_json(F.col("value"), MESSAGE, options)
    # A generated row, not a struct column: a filter on the events is then never pushed below the
    # parser, where each condition would parse the message again.
    parsed = messages.select("value", F.inline(F.array(e)))
    columns = {}
    fraction, bad_time = F.lit(False), F.lit(False)
    for f in EVENT.fields:
        c = F.col(f.name)
        if f.name == "ingestion_time":
            columns[f.name] = F.current_timestamp() if received_at is None else received_at
        elif isinstance(f.dataType, LongType):
            # try_cast: NaN and out-of-range numbers give NULL and are then reported.
            whole = c.try_cast("bigint")
            columns[f.name] = whole
            fraction = fraction | (c.isNotNull() & ~F.coalesce(whole.cast("double") == c, F.lit(False)))
        elif isinstance(f.dataType, TimestampType):
            columns[f.name] = derive.parse_iso_timestamp(c)
            bad_time = bad_time | (c.isNotNull() & (c != "") & columns[f.name].isNull())
        else:
            columns[f.name] = c
    # The parser stops at the end of the first object; text after it must not pass.
    outer = F.json_object_keys(F.concat(F.lit('{"m":'), F.col("value"), F.lit(',"end":1}')))
    one_object = F.coalesce(outer == F.array(F.lit("m"), F.lit("end")), F.lit(False))
    error = (
        F.when(~F.is_valid_utf8("value"), "invalid_encoding")
        .when(~one_object | F.col(_CORRUPT).isNotNull(), "malformed_message")
        .when(fraction, "not_a_whole_number")
        .when(bad_time, "unreadable_time")
    )
    return parsed.select("value", error.alias("error"), *[c.alias(n) for n, c in columns.items()])


def validate_events(
    events: DataFrame,
    unknown_zones: Iterable[int] = UNKNOWN_ZONES,
    components: Iterable[str] = STREAM_COMPONENTS,
    checked_at: Column | None = None,
) -> DataFrame:
    """Add the rule flags, ``is_valid``, ``quarantine_reason`` and ``dq_checked_at``."""
    flagged = flag_events(events, validity_rules(unknown_zones), tuple(components))
    return flagged.withColumn("dq_checked_at", F.current_timestamp() if checked_at is None else checked_at)


def derive_event_columns(events: DataFrame, fill_labels: bool = False) -> DataFrame:
    """Derived columns under the stream rules.

    ``store_and_fwd_flag_label`` stays NULL unless ``fill_labels`` is set.
    """
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    flag_label = derive.store_flag_label(F.col("store_and_fwd_flag"))
    return events.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_hour": derive.pickup_hour(pickup),
            "pickup_day_name": derive.day_name(pickup),
            "is_weekend": derive.is_weekend(pickup),
            "trip_duration_minutes": derive.rounded_minutes(pickup, dropoff),
            "time_period": derive.time_period(F.hour(pickup), null_is_night=False),
            "payment_label": derive.payment_label(F.col("payment_type")),
            "store_and_fwd_flag_label": flag_label if fill_labels else F.lit(None).cast("string"),
        }
    )


CLEAN, QUARANTINE, DEAD = "clean", "quarantine", "dead_letter"


def assign_route(validated: DataFrame) -> DataFrame:
    """Add ``route``. A valid event that lacks what the clean table requires is a dead letter."""
    missing = F.col("event_id").isNull() | F.col("event_time").isNull()
    error = F.coalesce("error", F.when(F.col("is_valid") & missing, "missing_required_field"))
    return validated.withColumn("error", error).withColumn(
        "route",
        F.when(F.col("error").isNotNull(), DEAD).when(F.col("is_valid"), CLEAN).otherwise(QUARANTINE),
    )
