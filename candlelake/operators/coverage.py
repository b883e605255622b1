"""Coverage of the target: days that a symbol lacks though others have them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trading_days(bars: DataFrame) -> DataFrame:
    """``bar_date, k``: the days that any symbol has, numbered from 0 (one row per day of the calendar)."""
    days = bars.select("bar_date").filter(F.col("bar_date").isNotNull()).distinct()
    return days.withColumn("k", F.row_number().over(Window.orderBy("bar_date")) - 1)  # as many rows as days, whatever the table holds


def coverage_gaps(bars: DataFrame, longest: int | None = None) -> DataFrame:
    """``symbol, from_date, to_date, days``: runs of days that other symbols have and this one lacks, from its first day on
    (its silence up to the calendar's last day is one too). ``longest``: gaps of more days are left out, such as
    those of a symbol that ended.

    Days are numbered along the calendar, so a gap is a jump between a symbol's neighbouring numbers; the days
    inside are never listed. A symbol has at most one row per calendar day, which bounds a window's group.
    """
    calendar = trading_days(bars)
    keys = bars.select("symbol", "bar_date").filter(F.col("symbol").isNotNull()).join(calendar, "bar_date")
    last = calendar.agg(F.max("k").alias("last"))
    # a day after the last one closes every symbol's row
    ends = keys.groupBy("symbol").agg(F.max("k").alias("before")).join(F.broadcast(last)).select("symbol", "before", (F.col("last") + 1).alias("k"))
    inside = keys.select("symbol", F.lag("k").over(Window.partitionBy("symbol").orderBy("k")).alias("before"), "k")
    jumps = inside.unionByName(ends).filter(F.col("k") - F.col("before") > 1)
    jumps = jumps.select("symbol", (F.col("before") + 1).alias("a"), (F.col("k") - 1).alias("b"), (F.col("k") - F.col("before") - 1).cast("bigint").alias("days"))
    if longest is not None:
        jumps = jumps.filter(F.col("days") <= longest)
    first, until = (calendar.select(F.col("k").alias(k), F.col("bar_date").alias(name)) for k, name in (("a", "from_date"), ("b", "to_date")))
    return jumps.join(first, "a").join(until, "b").select("symbol", "from_date", "to_date", "days")


def in_gaps(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """The rows whose day lies in a gap of their symbol. Gaps of a symbol do not overlap, so no row comes twice."""
    g = gaps.select(F.col("symbol").alias("_symbol"), "from_date", "to_date")
    on = (F.col("symbol") == F.col("_symbol")) & F.col("bar_date").between(F.col("from_date"), F.col("to_date"))
    return rows.join(g, on).select(*rows.columns)
