from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelens.functions import derive

START = datetime(2026, 4, 11, 10, 0, 0)


def one(spark, df_col, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {t}" for n, t in zip(names, ["timestamp"] * len(names))))
    return df.select(df_col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "seconds, whole, rounded",
    [(3599, 59, 60), (150, 2, 2), (210, 3, 4), (-3599, -59, -60), (0, 0, 0), (59, 0, 1), (30, 0, 0)],
)
def test_minutes_are_cut_in_batch_and_rounded_in_stream(spark, seconds, whole, rounded):
    end = START + timedelta(seconds=seconds)
    a, b = F.col("a"), F.col("b")
    assert one(spark, derive.whole_minutes(a, b), a=START, b=end) == whole
    assert one(spark, derive.rounded_minutes(a, b), a=START, b=end) == rounded


def test_half_minute_with_fraction_rounds_up(spark):
    end = START + timedelta(seconds=150, microseconds=1)
    assert one(spark, derive.rounded_minutes(F.col("a"), F.col("b")), a=START, b=end) == 3


def test_time_period_borders(spark):
    hours = spark.range(24).withColumn("p", derive.time_period(F.col("id"), null_is_night=True))
    names = [r["p"] for r in hours.orderBy("id").collect()]
    assert names == ["Late Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 5 + ["Evening"] * 4 + ["Night"] * 3


def test_time_period_without_hour(spark):
    df = spark.sql("select cast(null as int) as h")
    row = df.select(
        derive.time_period(F.col("h"), null_is_night=True).alias("batch"),
        derive.time_period(F.col("h"), null_is_night=False).alias("stream"),
    ).first()
    assert (row["batch"], row["stream"]) == ("Night", None)


def test_labels(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (3, "x"), (4, None), (5, ""), (None, "Y")], "p int, f string")
    rows = df.select(derive.payment_label(F.col("p")).alias("p"), derive.store_flag_label(F.col("f")).alias("f")).collect()
    assert [r["p"] for r in rows] == ["Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Unknown"]
    assert [r["f"] for r in rows] == ["Store and Forward", "Normal", "Unknown", "Unknown", "Unknown", "Store and Forward"]


def test_weekend_and_names(spark):
    row = spark.sql("select timestamp'2026-04-11 10:00:00' as a, timestamp'2026-04-13 00:00:00' as b").select(
        derive.is_weekend(F.col("a")).alias("sat"),
        derive.is_weekend(F.col("b")).alias("mon"),
        derive.day_name(F.col("a")).alias("day"),
        derive.month_key(F.col("a")).alias("month"),
    ).first()
    assert tuple(row) == (True, False, "Saturday", "2026-04")


def test_key_with_and_without_separator(spark):
    df = spark.createDataFrame([(1, 12), (11, 2)], "a int, b int")
    cols = [F.col("a"), F.col("b")]
    for digest in ("md5", "xxhash64"):
        joined = [r["k"] for r in df.select(derive.surrogate_key(cols, "", digest).alias("k")).collect()]
        apart = [r["k"] for r in df.select(derive.surrogate_key(cols, digest=digest).alias("k")).collect()]
        assert joined[0] == joined[1]
        assert apart[0] != apart[1]


def test_key_null_is_empty_text_in_its_place(spark):
    df = spark.sql("select cast(null as int) as a, 1 as b union all select 1, null")
    keys = [r["k"] for r in df.select(derive.surrogate_key([F.col("a"), F.col("b")]).alias("k")).collect()]
    assert keys[0] is not None and keys[0] != keys[1]


def test_iso_times(spark):
    df = spark.createDataFrame([("2026-06-01T10:00:00.123456+00:00",), ("2026-06-01T12:00:00+02:00",), ("",), (None,), ("soon",)], "t string")
    times = [r["t"] for r in df.select(derive.parse_iso_timestamp(F.col("t")).cast("string").alias("t")).collect()]
    assert times == ["2026-06-01 10:00:00.123456", "2026-06-01 10:00:00", None, None, None]
