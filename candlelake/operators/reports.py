"""Reports over a table: ordering, top-k, preview, counts, and text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed_width_line, labelled_line


def ordered_scan(df: DataFrame, *keys: str) -> DataFrame:
    """``SELECT * ... ORDER BY keys`` (a total order: range-partitioned sort)."""
    return df.orderBy(*keys)


def latest_bars(df: DataFrame, n: int = 10) -> DataFrame:
    """``ORDER BY bar_date DESC, symbol LIMIT n`` - a top-k (TakeOrderedAndProject), no full sort."""
    return df.orderBy(F.col("bar_date").desc(), F.col("symbol").asc()).limit(n)


def preview(df: DataFrame, n: int = 5, keys: tuple[str, ...] = ("symbol", "bar_date")) -> DataFrame:
    """A deterministic preview: first n rows in key order."""
    return df.orderBy(*keys).limit(n)


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def rows_per_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_per_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.max("bar_date").alias("latest_date"))


def fixed_width_report(employees: DataFrame) -> DataFrame:
    """``id, line``: the five employee columns left-aligned in widths 5, 15, 15 and 10, the date last;
    longer values push the rest to the right."""
    return employees.select("id", fixed_width_line().alias("line"))


def labelled_report(employees: DataFrame) -> DataFrame:
    return employees.select("id", labelled_line().alias("line"))
