"""Distributions, summaries and samples of raw trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, TimestampNTZType, TimestampType

from farelens.functions import derive
from farelens.operators.percentiles import exact_percentiles, fold_values, select_percentiles, summarize_values
from farelens.session import materialize

# Profiled columns, sample size and seed.
PROFILED_COLUMNS = (
    "VendorID",
    "payment_type",
    "trip_type",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "store_and_fwd_flag",
    "cbd_congestion_fee",
)
FARE_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)
SAMPLE_ROWS = 10_000
SAMPLE_SEED = 42
SAMPLE_SECTION = "trip_distance_values"
# Entries of one document of the profile, about.
DOCUMENT_ENTRIES = 50_000
RATIO_QUANTILES = {"p10": 0.1, "median": 0.5, "p90": 0.9}


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DoubleType, FloatType))


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c.isNull() | F.isnan(c) if _is_float(df, name) else c.isNull()


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def hour_distribution(df: DataFrame, ts_col: str = "lpep_pickup_datetime") -> DataFrame:
    """Share of trips per pickup hour, with all 24 hours; missing times do not count."""
    hour = F.hour(ts_col)
    counts = df.agg(F.count(ts_col).alias("n"), *[F.count_if(hour == h).alias(str(h)) for h in range(24)])
    tall = counts.unpivot("n", [str(h) for h in range(24)], "hour", "k")
    return tall.select(
        F.col("hour").cast("int").alias("hour"),
        F.coalesce(F.try_divide("k", "n"), F.lit(0.0)).alias("probability"),
    )


def _value_counts(df: DataFrame, columns: Sequence[str], null_key: str | None) -> DataFrame:
    """Rows ``(column, value, n)`` for all columns in one pass; values as text."""
    texts = []
    for name in columns:
        # Adding 0.0 makes the two floating zeros one value.
        plain = F.col(name) + F.lit(0.0) if _is_float(df, name) else F.col(name)
        text = F.when(~_missing(df, name), plain.cast("string"))
        texts.append((text if null_key is None else F.coalesce(text, F.lit(null_key))).alias(name))
    tall = df.select(*texts).unpivot([], list(columns), "column", "value")
    return tall.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _with_total(counts: DataFrame, column: str) -> DataFrame:
    """Add the number of rows; every column has that many values, so one column is added up.

    The counts are stored first: the rows behind them are read once.
    """
    counts = materialize(counts, "value-counts")
    total = counts.filter(F.col("column") == column).agg(F.sum("n")).scalar()
    return counts.withColumn("total", total)


def category_distribution(df: DataFrame, columns: Sequence[str] = PROFILED_COLUMNS) -> DataFrame:
    """Probability of each value of each column; NULL has the key ``null``."""
    counts = _with_total(_value_counts(df, columns, "null"), columns[0])
    return counts.select("column", "value", (F.col("n") / F.col("total")).alias("probability"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and percent (two places) of each value of each column, NULL included."""
    counts = _with_total(_value_counts(df, columns, None), columns[0])
    return counts.select(
        "column",
        "value",
        F.col("n").alias("n_rows"),
        F.round(F.col("n") * 100 / F.col("total"), 2).alias("percentage"),
    ).orderBy("column", F.asc_nulls_last("value"))


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of a column with count and percent."""
    counts = materialize(df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows")), "value-counts")
    total = counts.agg(F.sum("n_rows")).scalar()
    return (
        counts.orderBy(F.desc("n_rows"), F.asc_nulls_last("value"))
        .limit(k)
        .withColumn("percentage", F.round(F.col("n_rows") * 100 / total, 2))
    )


def ratio_columns(
    pickup: str = "lpep_pickup_datetime", dropoff: str = "lpep_dropoff_datetime"
) -> dict[str, Column]:
    """Fare per mile, tip per fare and miles per hour, each only where both parts are positive."""

    def ratio(num: Column, den: Column) -> Column:
        value = F.when((num > 0) & (den > 0), F.try_divide(num, den))
        return F.when(~F.isnan(value) & (value != F.lit(float("inf"))), value)

    distance, fare, tip = (F.col(c) for c in ("trip_distance", "fare_amount", "tip_amount"))
    hours = derive.elapsed_minutes(F.col(pickup), F.col(dropoff)) / 60
    return {
        "fare_per_mile": ratio(fare, distance),
        "tip_per_fare": ratio(tip, fare),
        "speed_distribution": ratio(distance, hours),
    }


def ratio_percentiles(df: DataFrame, ratios: Mapping[str, Column] | None = None) -> DataFrame:
    """p10, median and p90 of each ratio."""
    ratios = ratio_columns() if ratios is None else ratios
    found = exact_percentiles(df, ratios, list(RATIO_QUANTILES.values()))
    return found.select("name", derive.label_from(F.col("quantile"), {q: n for n, q in RATIO_QUANTILES.items()}).alias("stat"), "value")


def ratio_percentiles_approx(df: DataFrame, ratios: Mapping[str, Column] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Sketch percentiles: one pass whatever the size, rank error at most rows / accuracy."""
    ratios = ratio_columns() if ratios is None else ratios
    quantiles = F.array(*[F.lit(q) for q in RATIO_QUANTILES.values()])
    wide = df.agg(*[F.percentile_approx(c, quantiles, accuracy).alias(n) for n, c in ratios.items()])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("name"), F.lit(s).alias("stat"), F.col(n)[i].alias("value"))
                    for n in ratios
                    for i, s in enumerate(RATIO_QUANTILES)
                ]
            )
        )
    )


def row_text(df: DataFrame) -> Column:
    """All columns of a row as one text, NULL apart from every value."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in df.columns])


def reference_sample(
    df: DataFrame,
    column: str,
    key: Column | None = None,
    n: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """At most ``n`` non-NULL values drawn without replacement; all values if there are no more.

    The draw is the ``n`` smallest digests of seed and row ``key`` (the whole row where none is given), ties by value:
    the same on any partitioning and in every run. Rows of one key and value are copies, told apart by their number;
    they are counted, combined before the shuffle, and only numbers tell them apart. Rows far above the expected cut are
    dropped before the sort.
    """
    present = df.filter(~_missing(df, column))
    text = row_text(df) if key is None else key.cast("string")
    rows = present.select(F.col(column).alias("value"), F.md5(F.concat_ws("-", F.lit(str(seed)), text)).alias("digest"))
    folded = materialize(rows.groupBy("value", "digest").agg(F.count(F.lit(1)).alias("copies")), "sample-rows")
    total = folded.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    copy = folded.select("value", "digest", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
    own = F.when(F.col("copy") == 1, F.col("digest")).otherwise(F.md5(F.concat_ws("-", "digest", F.col("copy").cast("string"))))
    drawn = copy.select("value", own.alias("digest"))
    if total <= n:
        return drawn.select("value")
    # Digests are uniform: twice the expected cut holds n of them but for a vanishing chance, which is ruled out.
    cut = f"{min(int(16**12 * 2 * n / total), 16**12 - 1):012x}"
    near = materialize(drawn.filter(F.substring("digest", 1, 12) <= cut), "sample-near")
    return (near if near.limit(n).count() == n else drawn).orderBy("digest", "value").limit(n).select("value")


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing values per column, most first."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    return (
        wide.unpivot("_rows", df.columns, "column", "missing_values")
        .select(
            "column",
            "missing_values",
            (F.try_divide("missing_values", "_rows") * 100).alias("percentage"),
        )
        .orderBy(F.desc("missing_values"), "column")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns.

    A first pass shuffles only a 64-bit hash per row and keeps hashes seen more than once. Full rows
    are compared, after partial aggregation, only for those hashes.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    suspects = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_hash")
    suspects = materialize(suspects, "repeated-hashes")
    groups = (
        hashed.join(suspects, "_hash", "left_semi")
        .groupBy(*df.columns)
        .agg((F.count(F.lit(1)) - 1).alias("extra_rows"))
    )
    return groups.agg(F.coalesce(F.sum("extra_rows"), F.lit(0)).alias("duplicate_rows"))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, fewest first."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        tall = wide.unpivot([], df.columns, "column", "unique_values")
    else:
        pairs = _value_counts(df, df.columns, None)
        tall = pairs.groupBy("column").agg(F.count("value").alias("unique_values"))
    return tall.orderBy("unique_values", "column")


def _described(df: DataFrame, columns: Mapping[str, Column], quantiles: Mapping[str, float]) -> DataFrame:
    """One row per column with count, mean, deviation, extremes and quantiles; NaN counts as missing.

    Everything is taken from the folded values, so that ``df`` is read once.
    """
    folded = fold_values(df, columns)
    found = select_percentiles(folded, list(columns), list(quantiles.values()))
    wide = found.groupBy("name").agg(*[F.max(F.when(F.col("quantile") == q, F.col("value"))).alias(n) for n, q in quantiles.items()])
    summary = summarize_values(folded, list(columns))
    # Both sides have one row per summarized column.
    return summary.join(F.broadcast(wide), summary["column"] == wide["name"], "left").drop("name")


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the numeric columns."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    described = _described(df, {c: F.col(c) for c in columns}, QUARTILES)
    return described.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_times(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, minimum, quartiles and maximum of the time columns."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))]
    described = _described(df, {c: derive.micros(F.col(c)) for c in columns}, QUARTILES)
    return described.select(
        "column",
        "count",
        *[F.timestamp_micros(F.col(c).cast("bigint")).alias(c) for c in ("mean", "min", "p25", "p50", "p75", "max")],
    )


def fare_summary(df: DataFrame, columns: Sequence[str] = FARE_COLUMNS) -> DataFrame:
    """Count, mean, median, minimum and maximum of the fare columns."""
    described = _described(df, {c: F.col(c) for c in columns}, {"median": 0.5})
    return described.select("column", "count", "mean", "median", "min", "max")


def profile_rows(df: DataFrame, sample_key: Column | None = None) -> DataFrame:
    """The whole profile as rows ``(section, name, key, value)``; of any size."""
    hours = hour_distribution(df).select(
        F.lit("hour_distribution").alias("section"), F.lit("").alias("name"), F.col("hour").cast("string").alias("key"), F.col("probability").alias("value")
    )
    ratios = ratio_percentiles(df).select(
        F.col("name").alias("section"), F.lit("").alias("name"), F.col("stat").alias("key"), "value"
    )
    categories = category_distribution(df).select(
        F.lit("category_distribution").alias("section"), F.col("column").alias("name"), F.col("value").alias("key"), F.col("probability").alias("value")
    )
    sample = reference_sample(df, "trip_distance", sample_key).select(
        F.lit(SAMPLE_SECTION).alias("section"), F.lit("").alias("name"), F.lit("").alias("key"), F.col("value").cast("double").alias("value")
    )
    return hours.unionByName(ratios).unionByName(categories).unionByName(sample)


def write_profile(rows: DataFrame, path: str) -> None:
    """Store the profile rows as JSON lines, one folder per section."""
    rows.write.mode("overwrite").partitionBy("section").json(path)


def profile_document(rows: DataFrame, entries: int = DOCUMENT_ENTRIES) -> DataFrame:
    """The profile as nested JSON: rows ``(section, name, part, document)``, built in parallel.

    A document is the map of a section's keys to values or, for the sample, the list of its values. A section's name
    with more than ``entries`` entries is split into parts by leading digits of the key's digest, as many digits as it
    takes, so that a document is bounded whatever the column; the union of the parts is the map.
    """
    sizes = rows.groupBy("section", "name").agg(F.count(F.lit(1)).alias("size"))
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("size") / entries))).cast("int")
    # One row for each profiled column.
    sized = rows.join(F.broadcast(sizes.select("section", "name", digits.alias("digits"))), ["section", "name"])
    parted = sized.withColumn("part", F.left(F.md5(F.concat("key", F.coalesce(F.col("value").cast("string"), F.lit("")))), F.col("digits")))
    pairs = F.array_sort(F.collect_list(F.struct("key", "value")))
    grouped = parted.groupBy("section", "name", "part").agg(pairs.alias("pairs"))
    listed = F.array_sort(F.transform("pairs", lambda p: p["value"]))
    document = F.when(F.col("section") == SAMPLE_SECTION, F.to_json(listed)).otherwise(F.to_json(F.map_from_entries("pairs")))
    return grouped.select("section", "name", "part", document.alias("document"))


def write_profile_document(rows: DataFrame, path: str) -> None:
    """Store the profile's documents, one folder per section."""
    profile_document(rows).write.mode("overwrite").partitionBy("section").json(path)
