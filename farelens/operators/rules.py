"""Row rules, the duplicate rule, validity and quarantine reasons."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions import derive
from farelens.session import materialize

# Rule inputs, reason codes and key columns.
REQUIRED_FIELDS = ("vendor_id", "rate_code_id", "passenger_count", "payment_type", "trip_type")
UNKNOWN_ZONES = (264, 265)
STREAM_COMPONENTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)
BATCH_COMPONENTS = (*STREAM_COMPONENTS, "cbd_congestion_fee")
DUPLICATE_KEYS = ("vendor_id", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id")
DUPLICATE_REASON = "duplicate"


@dataclass(frozen=True)
class Rule:
    """A flag column that is true for a good row, and the reason code of a bad one."""

    name: str
    reason: str
    passes: Column


def _not_negative(name: str) -> Column:
    # Spark orders NaN above every number; here NaN is a bad amount.
    c = F.col(name)
    return (c >= 0) & ~F.isnan(c)


def validity_rules(unknown_zones: Iterable[int] = UNKNOWN_ZONES) -> list[Rule]:
    zones = list(unknown_zones)
    return [
        Rule("is_complete_record", "incomplete_record", reduce(and_, [F.col(c).isNotNull() for c in REQUIRED_FIELDS])),
        Rule("is_valid_distance", "invalid_distance", _not_negative("trip_distance")),
        Rule("is_valid_fare", "invalid_fare", _not_negative("fare_amount") & _not_negative("total_amount")),
        Rule("is_valid_passenger_count", "invalid_passenger_count", F.col("passenger_count") >= 1),
        Rule(
            "is_valid_location",
            "invalid_location",
            ~F.col("pu_location_id").isin(zones) & ~F.col("do_location_id").isin(zones),
        ),
    ]


RULE_NAMES = (
    "is_complete_record",
    "is_valid_distance",
    "is_valid_fare",
    "is_valid_passenger_count",
    "is_valid_location",
)


def recomputed_total(components: Sequence[str] = BATCH_COMPONENTS) -> Column:
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in components])


def cents_differ(total: Column, other: Column) -> Column:
    """Whether two amounts differ in cents; compared as whole cents, free of binary fractions."""
    return (F.round(total * 100) != F.round(other * 100)) | F.isnan(total)


def apply_rules(
    trips: DataFrame,
    rules: Sequence[Rule] | None = None,
    components: Sequence[str] = BATCH_COMPONENTS,
    null_policy: str = "sql",
) -> DataFrame:
    """Add the recomputed total, one flag per rule and ``amount_mismatch``.

    ``null_policy="sql"`` keeps three-valued flags: a missing value gives a NULL flag.
    ``"strict"`` makes a missing value fail its rule.
    """
    if null_policy not in ("sql", "strict"):
        raise ValueError(f"unknown null policy {null_policy!r}")
    strict = null_policy == "strict"
    rules = validity_rules() if rules is None else rules
    flags = {r.name: F.coalesce(r.passes, F.lit(False)) if strict else r.passes for r in rules}
    mismatch = cents_differ(F.col("total_amount"), F.col("total_amount_recomputed"))
    return (
        trips.withColumn("total_amount_recomputed", recomputed_total(components))
        .withColumns(flags)
        .withColumn("amount_mismatch", F.coalesce(mismatch, F.lit(True)) if strict else mismatch)
    )


def judge(flagged: DataFrame, rules: Sequence[Rule], duplicates: bool) -> DataFrame:
    """Add ``is_valid`` and ``quarantine_reason`` from the flag columns."""
    good = reduce(and_, [F.col(r.name) for r in rules])
    reasons = [F.when(~F.col(r.name), r.reason) for r in rules]
    if duplicates:
        good = good & ~F.col("is_duplicate")
        reasons.append(F.when(F.col("is_duplicate"), DUPLICATE_REASON))
    return flagged.withColumns({"is_valid": good, "quarantine_reason": F.concat_ws(", ", *reasons)})


def repeated_keys(df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n_copies``.

    Only the key columns are shuffled, after partial aggregation, so a key that holds a large share
    of the rows arrives as one row per map task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_copies")).filter("n_copies > 1")


def mark_duplicates(df: DataFrame, repeated: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """Add ``n_copies`` (NULL for a unique key) and ``is_duplicate``; NULL keys equal each other.

    A join rather than a window over the key: the wide rows of a hot key are never gathered in one
    task. The few repeated keys are normally small enough to be broadcast; if not, the join is a
    shuffle whose skewed partitions AQE splits.
    """
    right = repeated.select(*[F.col(k).alias(f"_dup_{k}") for k in keys], "n_copies")
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_dup_{k}")) for k in keys])
    return (
        df.join(right, on, "left")
        .drop(*[f"_dup_{k}" for k in keys])
        .withColumn("is_duplicate", F.col("n_copies").isNotNull())
    )


def flag_trips(
    trips: DataFrame,
    repeated: DataFrame | None = None,
    rules: Sequence[Rule] | None = None,
    components: Sequence[str] = BATCH_COMPONENTS,
    null_policy: str = "sql",
    key_sep: str = derive.KEY_SEPARATOR,
    keep_copies: bool = False,
) -> DataFrame:
    """Staged trips with key, recomputed total, all flags, validity and reasons.

    ``repeated`` is a stored result of :func:`repeated_keys`; it is computed here if absent.
    Duplicates are judged among the given rows; the pickup time is part of the key, so judging
    several periods together equals judging each alone.
    """
    rules = validity_rules() if rules is None else rules
    if repeated is None:
        repeated = materialize(repeated_keys(trips), "repeated-keys")
    columns = trips.columns
    flagged = apply_rules(trips, rules, components, null_policy)
    flagged = judge(mark_duplicates(flagged, repeated), rules, duplicates=True)
    return flagged.select(
        derive.trip_key(key_sep).alias("trip_id"),
        *columns,
        "total_amount_recomputed",
        *[r.name for r in rules],
        "amount_mismatch",
        "is_duplicate",
        "is_valid",
        "quarantine_reason",
        *(["n_copies"] if keep_copies else []),
    )


def flag_events(
    events: DataFrame,
    rules: Sequence[Rule] | None = None,
    components: Sequence[str] = STREAM_COMPONENTS,
    null_policy: str = "strict",
) -> DataFrame:
    """Stream form: no duplicate rule, and no reason is NULL instead of empty text."""
    rules = validity_rules() if rules is None else rules
    flagged = judge(apply_rules(events, rules, components, null_policy), rules, duplicates=False)
    return flagged.drop("total_amount_recomputed").withColumn(
        "quarantine_reason", F.nullif(F.col("quarantine_reason"), F.lit(""))
    )
