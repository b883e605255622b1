"""Silver: parse the date, report quality in one pass (never dropping rows), keep the last copy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import KEY
from ..functions.bars import parse_date

CHECKED_COLUMNS = ("open", "high", "low", "close", "volume")


def parse(bronze: DataFrame) -> DataFrame:
    """``bar_date`` text -> DATE (strict; bad text becomes NULL, kept here and counted by ``dq_report``)."""
    return bronze.withColumn("bar_date", parse_date("bar_date"))


def keep_last(df: DataFrame, keys: tuple[str, ...] = KEY, order: str = "fetched_at") -> DataFrame:
    """One row per key: the values of the copy from the latest response (replays and retries
    collapse).

    One ``max_by`` per column over a fixed-width ordering keeps every aggregation buffer
    fixed-width, so the plan stays a hash aggregate with partial aggregation before the shuffle:
    a hot key reaches the reducer as one row per map task. Copies of one key come from different
    responses, whose fetch times differ; copies without a fetch time count as the earliest, and which of
    them stays depends on their values alone. Rows with a NULL key part are never merged with each
    other. ``n_copies`` > 1 marks a key that was duplicated before.
    """
    # an unknown time loses against any other, and never blanks the values; copies without one are told apart by a hash of their values
    values = [c for c in df.columns if c not in keys and c != order]
    unknown = F.lit(-(1 << 62)) - F.xxhash64(*values).bitwiseAND(F.lit((1 << 61) - 1))
    o = F.coalesce(F.unix_micros(order), unknown)
    aggs = [F.max(order).alias(c) if c == order else F.max_by(c, o).alias(c) for c in df.columns if c not in keys]
    # A row with a NULL key part is not a copy of anything: a unique tiebreak keeps it apart
    # (NULL, i.e. no effect, for every well-formed row).
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    apart = F.when(null_key, F.monotonically_increasing_id()).alias("_apart")
    grouped = df.groupBy(*keys, apart).agg(*aggs, F.count(F.lit(1)).alias("n_copies"))
    return grouped.drop("_apart")


def null_counts(df: DataFrame, columns: tuple[str, ...] = CHECKED_COLUMNS) -> DataFrame:
    """One job for all columns: ``<col>_nulls`` per checked column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}_nulls") for c in columns])


def duplicate_keys(df: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Number of keys held by more than one row (groups, as the reference counts) and the rows
    in them."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.filter(F.col("n") > 1).agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def dq_report(df: DataFrame, keys: tuple[str, ...] = KEY, columns: tuple[str, ...] = CHECKED_COLUMNS) -> DataFrame:
    """NULL checks, the key-uniqueness check and the rows whose key has a NULL part (a bad date, no
    symbol) in one shuffle:
    ``check, column, failures, status`` (PASS/FAIL), one row per check.

    Per-key partial counts are combined map-side, then one tiny global aggregate.
    """
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    ).withColumn("no_key", reduce(Column.__or__, [F.col(k).isNull() for k in keys]))
    totals = per_key.agg(
        *[F.sum(c).cast("bigint").alias(c) for c in columns],
        F.count_if((F.col("n") > 1) & ~F.col("no_key")).cast("bigint").alias("dup"),
        F.sum(F.when(F.col("no_key"), F.col("n"))).cast("bigint").alias("no_key"),
    )
    checks = [("not_null", c, c) for c in columns] + [("unique_key", ",".join(keys), "dup"), ("valid_key", ",".join(keys), "no_key")]
    stack = ", ".join(f"'{chk}', '{col}', coalesce(`{src}`, 0L)" for chk, col, src in checks)
    rows = totals.selectExpr(f"stack({len(checks)}, {stack}) AS (check, column, failures)")
    return rows.withColumn("status", F.when(F.col("failures") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")))


def to_silver(bronze: DataFrame) -> DataFrame:
    """Bronze -> silver: keep the last copy per (symbol, day text), then parse the date."""
    return parse(keep_last(bronze))


def loadable(silver: DataFrame) -> DataFrame:
    """The rows that have a key. The others are in ``bronze.rejects``, with their reasons."""
    return silver.filter(F.col("symbol").isNotNull() & F.col("bar_date").isNotNull())
