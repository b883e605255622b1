"""Counts and latest days of the target from the footers of its Parquet files, without reading a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import TARGET_STORED

#: Parquet by the second data source interface, whose scans take aggregates.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
MONTHS = "bar_month string, n bigint, first_date date, latest_date date"


class footer_settings:
    """The settings under which aggregates are taken from footers; they must hold while the query runs."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.was = {k: self.spark.conf.get(k, None) for k in FOOTERS}
        for k, v in FOOTERS.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *error) -> None:
        for k, v in self.was.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def months_query(spark: SparkSession, path: str) -> DataFrame:
    """The aggregate per month folder; to be planned and run under ``footer_settings``."""
    rows = spark.read.schema(TARGET_STORED).parquet(path)
    return rows.groupBy("bar_month").agg(F.count(F.lit(1)).alias("n"), F.min("bar_date").alias("first_date"), F.max("bar_date").alias("latest_date"))


def months_from_footers(spark: SparkSession, path: str) -> DataFrame:
    """``bar_month, n, first_date, latest_date`` of every month folder. One row per month comes to the driver."""
    with footer_settings(spark):
        months = [tuple(r) for r in months_query(spark, path).collect()]
    return spark.createDataFrame(months, MONTHS)
