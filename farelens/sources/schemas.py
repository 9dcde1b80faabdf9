"""Declared schemas of the raw, reference, event and output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _fields(kind: DataType, names: str, nullable: bool = True) -> list[StructField]:
    return [StructField(name, kind, nullable) for name in names.split()]


def _schema(*groups: list[StructField]) -> StructType:
    return StructType([field for group in groups for field in group])


# Column names and types of the source and output tables.
RAW_TRIP = _schema(
    _fields(LongType(), "VendorID"),
    _fields(TimestampType(), "lpep_pickup_datetime lpep_dropoff_datetime"),
    _fields(StringType(), "store_and_fwd_flag"),
    _fields(LongType(), "RatecodeID PULocationID DOLocationID passenger_count"),
    _fields(
        DoubleType(),
        "trip_distance fare_amount extra mta_tax tip_amount tolls_amount ehail_fee "
        "improvement_surcharge total_amount",
    ),
    _fields(LongType(), "payment_type trip_type"),
    _fields(DoubleType(), "congestion_surcharge cbd_congestion_fee"),
)

RAW_ZONE = _schema(
    _fields(LongType(), "LocationID"),
    _fields(StringType(), "Borough Zone service_zone"),
)

_EVENT_CODES = _fields(LongType(), "vendor_id rate_code_id passenger_count trip_type payment_type")
_EVENT_TRIP = [
    *_fields(TimestampType(), "pickup_datetime dropoff_datetime"),
    *_fields(StringType(), "store_and_fwd_flag"),
    *_fields(LongType(), "pu_location_id do_location_id"),
    *_fields(
        DoubleType(),
        "trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge "
        "congestion_surcharge cbd_congestion_fee total_amount",
    ),
]
_AUDIT = [*_fields(TimestampType(), "_loaded_at"), *_fields(StringType(), "_data_source")]

EVENT = _schema(
    _fields(StringType(), "event_id"),
    _fields(TimestampType(), "event_time ingestion_time"),
    _EVENT_CODES,
    _EVENT_TRIP,
)

STREAM_CLEAN = _schema(
    _fields(StringType(), "event_id", nullable=False),
    _fields(TimestampType(), "event_time ingestion_time", nullable=False),
    _EVENT_CODES,
    _EVENT_TRIP,
    _fields(DateType(), "pickup_date"),
    _fields(LongType(), "pickup_hour"),
    _fields(StringType(), "pickup_day_name"),
    _fields(BooleanType(), "is_weekend"),
    _fields(LongType(), "trip_duration_minutes"),
    _fields(StringType(), "time_period payment_label store_and_fwd_flag_label"),
    _AUDIT,
)

STREAM_QUARANTINE = _schema(
    list(EVENT.fields),
    _fields(
        BooleanType(),
        "is_valid is_complete_record is_valid_distance is_valid_fare is_valid_passenger_count "
        "is_valid_location amount_mismatch",
    ),
    _fields(StringType(), "quarantine_reason"),
    _fields(TimestampType(), "dq_checked_at"),
    _AUDIT,
)

DEAD_LETTER = _schema(
    _fields(StringType(), "value error"),
    _fields(TimestampType(), "ingestion_time"),
)


def select_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to ``schema``: extra columns go, missing ones become typed NULLs, order is fixed."""
    present = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
