"""Temp views with the reference's table and column names, so its SQL runs unchanged on
``spark.sql`` (e.g. ``SELECT symbol, MAX(date) FROM stock_daily GROUP BY symbol``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TARGET
from ..sinks.targets import JdbcTarget, ParquetTarget, as_target


def register_target_view(
    spark: SparkSession, target: str | ParquetTarget | JdbcTarget, name: str = "stock_daily"
) -> DataFrame | None:
    """``stock_daily(symbol, date, open, ..., candle)`` over the loaded target (None if absent)."""
    df = as_target(target).read(spark)
    if df is None:
        return None
    cols = ["`date`" if c == "bar_date" else c for c in TARGET.fieldNames()]
    view = df.withColumnRenamed("bar_date", "date").selectExpr(*cols)
    view.createOrReplaceTempView(name)
    return view


def register_employees_view(spark: SparkSession, employees: DataFrame, name: str = "employees") -> DataFrame:
    employees.createOrReplaceTempView(name)
    return employees
