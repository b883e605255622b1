"""Where a pipeline loads: a Parquet folder (tested) or a JDBC table (same calls, not exercised
here because no database may be started in this environment)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TARGET, TARGET_KEYS
from ..sources.tables import TARGET_STORED, existing_keys, existing_keys_jdbc, month_key, read_target
from .tables import merge_months, write_jdbc, write_target

# "Table does not exist": SQLSTATEs (ANSI/MySQL, PostgreSQL, Derby) and the drivers' messages,
# which usually carry no SQLSTATE. Only these make a first run; every other error propagates.
MISSING_TABLE_STATES = ("42S02", "42P01", "42X05")
MISSING_TABLE_MESSAGES = ("doesn't exist", "does not exist", "no such table", "undefined table")


class Target:
    """What a load needs of a target: ensure, window (keys or rows from a day on), read, write, merge."""

    def ensure(self, spark: SparkSession) -> None:
        raise NotImplementedError

    def keys(self, spark: SparkSession, fetch_from: dt.date | None = None) -> DataFrame:
        raise NotImplementedError

    def read(self, spark: SparkSession) -> DataFrame | None:
        raise NotImplementedError

    def write(self, df: DataFrame, mode: str) -> None:
        raise NotImplementedError

    def folder(self, spark: SparkSession) -> str:
        """The folder of its Parquet files."""
        raise NotImplementedError(f"{type(self).__name__} has no files")

    def window(self, spark: SparkSession, fetch_from: dt.date | None, values: bool = False) -> DataFrame:
        """The keys, or with ``values`` the rows, from a day on."""
        if not values:
            return self.keys(spark, fetch_from)
        rows = self.read(spark)
        rows = spark.createDataFrame([], TARGET) if rows is None else rows
        return rows if fetch_from is None else rows.filter(F.col("bar_date") >= F.lit(fetch_from))

    def merge(self, spark: SparkSession, rows: DataFrame, fetch_from: dt.date) -> None:
        """Puts in rows, in place of those with the same keys; all of them are of ``fetch_from`` or later."""
        raise NotImplementedError(f"{type(self).__name__} holds no revisions")


@dataclass
class ParquetTarget(Target):
    path: str

    def ensure(self, spark: SparkSession) -> None:
        """``CREATE TABLE IF NOT EXISTS``: an empty typed table; save mode "ignore" leaves an
        existing one untouched."""
        empty = spark.createDataFrame([], TARGET_STORED)
        empty.write.mode("ignore").partitionBy("bar_month").parquet(self.path)

    def keys(self, spark: SparkSession, fetch_from: dt.date | None = None) -> DataFrame:
        return existing_keys(spark, self.path, fetch_from)

    def read(self, spark: SparkSession) -> DataFrame | None:
        t = read_target(spark, self.path)
        return None if t is None else t.select(*TARGET.fieldNames())

    def folder(self, spark: SparkSession) -> str:
        return self.path

    def window(self, spark: SparkSession, fetch_from: dt.date | None, values: bool = False) -> DataFrame:
        if not values or fetch_from is None:
            return super().window(spark, fetch_from, values)
        rows = read_target(spark, self.path).filter((F.col("bar_month") >= F.lit(month_key(fetch_from))) & (F.col("bar_date") >= F.lit(fetch_from)))
        return rows.select(*TARGET.fieldNames())

    def write(self, df: DataFrame, mode: str) -> None:
        write_target(df, self.path, mode)

    def merge(self, spark: SparkSession, rows: DataFrame, fetch_from: dt.date) -> None:
        """Only the months that the rows touch are written again, from a copy that is complete before the
        first file of the target goes. A run lost in between is repeated: its landing still has the rows."""
        merge_months(spark, rows, self.path, fetch_from)


@dataclass
class JdbcTarget(Target):
    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    num_partitions: int | None = None
    batch_size: int = 10000
    date_column: str = "bar_date"

    def ensure(self, spark: SparkSession) -> None:
        """The table is created by its DDL (key, DECIMAL and domain definitions), or by the
        first write; a missing table reads as empty."""

    def _missing(self, exc: Exception) -> bool:
        text = str(exc)
        return any(s in text for s in MISSING_TABLE_STATES) or any(m in text.lower() for m in MISSING_TABLE_MESSAGES)

    def keys(self, spark: SparkSession, fetch_from: dt.date | None = None) -> DataFrame:
        try:
            df = existing_keys_jdbc(spark, self.url, self.table, self.properties, fetch_from, self.date_column)
            df.schema  # noqa: B018 - resolves the query against the database now
            return df
        except Exception as exc:  # noqa: BLE001
            if self._missing(exc):
                return spark.createDataFrame([], TARGET_KEYS)
            raise

    def read(self, spark: SparkSession) -> DataFrame | None:
        try:
            df = spark.read.format("jdbc").options(url=self.url, dbtable=self.table, **self.properties).load()
            df.schema  # noqa: B018
        except Exception as exc:  # noqa: BLE001
            if self._missing(exc):
                return None
            raise
        return df.withColumnRenamed(self.date_column, "bar_date") if self.date_column != "bar_date" else df

    def write(self, df: DataFrame, mode: str) -> None:
        """An empty append opens no connection (the rows are persisted once for the check and
        the write, so the plan runs once)."""
        out = df.select(*TARGET.fieldNames())
        if self.date_column != "bar_date":
            out = out.withColumnRenamed("bar_date", self.date_column)
        if mode != "append":
            write_jdbc(out, self.url, self.table, self.properties, mode, self.num_partitions, self.batch_size)
            return
        out = out.persist()
        try:
            if not out.isEmpty():
                write_jdbc(out, self.url, self.table, self.properties, mode, self.num_partitions, self.batch_size)
        finally:
            out.unpersist()


def as_target(target: str | Target) -> Target:
    return ParquetTarget(target) if isinstance(target, str) else target

