"""Target-table scans (S3, S4) and literal rows (S5)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MARKS, TARGET, TARGET_KEYS

# Stored layout: the target columns plus the month partition column.
TARGET_STORED = T.StructType(TARGET.fields + [T.StructField("bar_month", T.StringType(), True)])


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The target table, or None when it does not exist yet (first run).

    Only a missing path counts as a first run; any other error (permissions, corrupt files)
    propagates instead of silently turning every row into a new one.
    """
    try:
        return spark.read.schema(TARGET_STORED).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or "") or "Path does not exist" in str(exc):
            return None
        raise


def month_key(d: dt.date) -> str:
    return d.strftime("%Y-%m")


def existing_keys(spark: SparkSession, target_path: str, fetch_from: dt.date | None = None) -> DataFrame:
    """``SELECT symbol, bar_date FROM target [WHERE bar_date >= fetch_from]``.

    Incoming rows all satisfy ``bar_date >= fetch_from``, so keys older than that can never match
    and the window may be applied to the target too: on the month partition column (folders
    skipped) and on ``bar_date`` (row groups skipped). An empty key set stands in for a missing
    target.
    """
    target = read_target(spark, target_path)
    if target is None:
        return spark.createDataFrame([], TARGET_KEYS)
    if fetch_from is not None:
        target = target.filter(
            (F.col("bar_month") >= F.lit(month_key(fetch_from))) & (F.col("bar_date") >= F.lit(fetch_from))
        )
    return target.select("symbol", "bar_date")


def existing_keys_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    fetch_from: dt.date | None = None,
    date_column: str = "bar_date",
) -> DataFrame:
    """The same key scan over JDBC; the window predicate is sent to the database."""
    query = f"SELECT symbol, {date_column} AS bar_date FROM {table}"
    if fetch_from is not None:
        query += f" WHERE {date_column} >= DATE '{fetch_from.isoformat()}'"
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load()


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """High-water marks, one row per successful load (empty before the first)."""
    try:
        return spark.read.schema(MARKS).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or "") or "Path does not exist" in str(exc):
            return spark.createDataFrame([], MARKS)
        raise


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Fixture and golden rows with an explicit schema."""
    return spark.createDataFrame(rows, schema)
