"""Do two tables hold the same rows? Order-free checksums per month first, rows only where months differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import KEY
from .incremental import row_hash


def month_checksums(bars: DataFrame) -> DataFrame:
    """``bar_month, n, checksum``: the sum of the rows' 64-bit hashes, whatever their order. One row per month."""
    rows = bars.select(F.date_format("bar_date", "yyyy-MM").alias("bar_month"), row_hash(bars.columns).alias("h"))
    return rows.groupBy("bar_month").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("checksum"))


def load_diff(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """``symbol, bar_date, difference`` (only_left, only_right or changed) of every key whose rows are not the same in both.

    Tables that agree are only summed up per month. Where a month's sums differ its rows are joined by key;
    rows that repeat a key are summed up by key before that. Rows without a date or symbol are compared too.
    """
    a, b = month_checksums(left), month_checksums(right)
    on = a["bar_month"].eqNullSafe(b["bar_month"])
    same = a["n"].eqNullSafe(b["n"]) & a["checksum"].eqNullSafe(b["checksum"])
    # a month that only one table has is joined to nothing, and its counts are NULL on one side
    months = a.join(b, on, "full").filter(~same).select(F.coalesce(a["bar_month"], b["bar_month"]).alias("_month"))

    def per_key(rows: DataFrame, side: str) -> DataFrame:
        rows = rows.withColumn("_h", row_hash(rows.columns))
        rows = rows.join(months, F.date_format("bar_date", "yyyy-MM").eqNullSafe(F.col("_month")), "left_semi")
        return rows.groupBy(*[F.col(k).alias(f"{side}_{k}") for k in keys]).agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("h")).alias(side))

    both = per_key(left, "l").join(per_key(right, "r"), [F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in keys], "full")
    difference = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(F.col("l") != F.col("r"), "changed")
    return both.select(*[F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys], difference.alias("difference")).filter("difference is not null")
