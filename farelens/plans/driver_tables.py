"""Trips, zones and event messages derived from the order and event tables.

Every order line is a trip: order date and order number give the pickup, quantity and part the
length, customer and supplier nation the two locations. A returned line is a refund, with negative amounts; some short
ones are void, without any length. A line with the highest tax and discount was submitted twice. Every event is a message; an ``error`` event is a message that is not JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.operators.staging import stage_trips, stage_zones
from farelens.session import spread

# The two nations that stand for unknown zones.
UNKNOWN_NATIONS = (23, 24)


# Declared, so that planning a query reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    ordered = orders.join(customers, F.expr("o_custkey = c_custkey"))
    # Lines and orders grow together: neither is ever broadcast, however small its pruned columns look.
    lines = table(spark, sf_dir, "lineitem").hint("merge")
    joined = lines.join(ordered, F.expr("l_orderkey = o_orderkey")).join(suppliers, F.expr("l_suppkey = s_suppkey"))
    submitted = joined.selectExpr(
        "*",
        "explode(if(l_tax = 0.08 and l_discount = 0.1, array(1, 2), array(1))) as submission",
        "timestampadd(MINUTE, cast(l_orderkey % 1440 as int), o_orderdate) as pickup",
        "if(l_linestatus = 'F' and l_returnflag = 'A', -1.0D, 1.0D) as sign",
        "l_quantity = 2 and l_partkey % 3 = 0 as void",
    ).selectExpr(
        "*",
        "sign * l_extendedprice as fare",
        "sign * floor(l_extendedprice * l_tax * 100 + 0.5D) / 100 as surcharge",
        "sign * floor(l_extendedprice * l_discount * 100 + 0.5D) / 100 as tip",
        "if(l_linenumber = 1, null, sign * 2.75D) as congestion",
        "if(l_linenumber = 2, sign * 0.75D, 0.0D) as cbd",
        "if(l_partkey % 10 = 0, sign * 5.0D, 0.0D) as tolls",
    )
    return submitted.selectExpr(
        "cast(l_linenumber as bigint) as VendorID",
        "pickup as lpep_pickup_datetime",
        "timestampadd(SECOND, case when void then 0 when l_quantity = 2 and l_partkey % 3 = 1 then 90 else cast(cast(l_quantity as int) * 60 - 300 + l_partkey % 60 as int) end, pickup)"
        " as lpep_dropoff_datetime",
        "case l_returnflag when 'N' then 'N' when 'R' then 'Y' end as store_and_fwd_flag",
        "nullif(l_partkey % 7, 6) as RatecodeID",
        "cast(c_nationkey as bigint) as PULocationID",
        "cast(s_nationkey as bigint) as DOLocationID",
        "if(l_partkey % 50 = 7, -1L, cast(l_quantity as bigint) % 10) as passenger_count",
        "nullif(l_quantity, 49) - 2 as trip_distance",
        "fare as fare_amount",
        "surcharge as extra",
        "sign * 0.5D as mta_tax",
        "tip as tip_amount",
        "tolls as tolls_amount",
        "cast(null as double) as ehail_fee",
        "sign * 1.0D as improvement_surcharge",
        "if(void and l_partkey % 2 = 0, 0.0D, floor((fare + surcharge + sign * 0.5D + tip + tolls + sign * 1.0D + coalesce(congestion, 0.0D) + cbd"
        " + if(l_linenumber = 3, 1.0D, 0.0D)) * 100 + 0.5D) / 100) as total_amount",
        "cast(substring(o_orderpriority, 1, 1) as bigint) as payment_type",
        "cast(l_linenumber % 2 + 1 as bigint) as trip_type",
        "congestion as congestion_surcharge",
        "cbd as cbd_congestion_fee",
    )


def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_trips(raw_trips(spark, sf_dir))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; one region has no borough name."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nations.join(regions, F.expr("n_regionkey = r_regionkey"), "left").select(
        F.expr("cast(n_nationkey as bigint) as LocationID"),
        F.expr("nullif(r_name, 'AFRICA') as Borough"),
        F.expr("n_name as Zone"),
        F.expr("'Zone' as service_zone"),
    )


def staged_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_zones(raw_zones(spark, sf_dir))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text ``value`` per event, with its ``event_type``."""
    iso = "yyyy-MM-dd\'T\'HH:mm:ss.SSSSSSXXX"
    scan = table(spark, sf_dir, "events")
    events = spread(scan, scan, "event_id").selectExpr("*", "cast(get_json_object(props, '$.k') as bigint) as k")
    events = events.selectExpr(
        "*",
        f'date_format(ts, "{iso}") as started',
        f'date_format(timestampadd(SECOND, cast(k * 60 + user_id as int), ts), "{iso}") as ended',
        "if(k = 51, -value, value) as fare",
        "floor(value * 10) / 100 as tip",
        "if(event_type = 'purchase', 2.75D, null) as congestion",
        "if(event_type = 'view', 0.75D, 0.0D) as cbd",
    )
    fields = {
        "event_id": "cast(event_id as string)",
        "event_time": "started",
        "vendor_id": "user_id % 2 + 1",
        "rate_code_id": "nullif(user_id % 7, 6)",
        "passenger_count": "k % 7",
        "trip_type": "k % 2 + 1",
        "payment_type": "k % 5 + 1",
        "pickup_datetime": "started",
        "dropoff_datetime": "ended",
        "store_and_fwd_flag": "case event_type when 'view' then 'N' when 'click' then 'Y' end",
        "pu_location_id": "user_id % 25",
        "do_location_id": "k % 25",
        "trip_distance": "if(k = 50, null, value / 10 - 1)",
        "fare_amount": "fare",
        "extra": "0.5D",
        "mta_tax": "0.5D",
        "tip_amount": "tip",
        "tolls_amount": "0.0D",
        "improvement_surcharge": "1.0D",
        "congestion_surcharge": "congestion",
        "cbd_congestion_fee": "cbd",
        "total_amount": "if(k = 52, null, floor((fare + 0.5D + 0.5D + tip + 0.0D + 1.0D + coalesce(congestion, 0.0D) + cbd"
        " + if(event_type = 'click', 1.0D, 0.0D)) * 100 + 0.5D) / 100)",
    }
    message = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return events.selectExpr(
        "event_type",
        f"if(event_type = 'error', concat('error ', event_id), to_json(named_struct({message}))) as value",
    )
