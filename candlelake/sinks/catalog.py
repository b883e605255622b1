"""Targets that are tables of the catalog: a reload that is a change of metadata, and keys that lie co-located."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TARGET, TARGET_KEYS
from ..sources.tables import TARGET_STORED, month_key
from .tables import merge_months, remove, stored_form
from .targets import Target

#: Whether a new table keeps its partitions in the catalog.
IN_CATALOG = "spark.sql.hive.manageFilesourcePartitions"


@dataclass
class CatalogTarget(Target):
    """A table over one of several load folders below ``root``.

    A reload writes a new folder and then points the table at it (``ALTER TABLE ... SET LOCATION``). No data
    file is moved, readers see the old rows until the switch and never a missing table, and a
    load that fails before it changes nothing. Old folders stay until ``clean``, for readers that still use them.
    """

    name: str
    root: str

    def location(self, spark: SparkSession) -> str:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'Location'").select("data_type")
        return rows.first()[0]

    def folder(self, spark: SparkSession) -> str:
        return self.location(spark)

    def _fresh(self) -> str:
        return f"{self.root.rstrip('/')}/load-{uuid.uuid4().hex[:12]}"

    def ensure(self, spark: SparkSession) -> None:
        """An empty table. Its partitions are the folders of its location, not entries of the catalog, so
        that a new location is all that a reload has to set."""
        if spark.catalog.tableExists(self.name):
            return
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TARGET_STORED.fields)
        was = spark.conf.get(IN_CATALOG)
        spark.conf.set(IN_CATALOG, "false")
        try:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({fields}) USING parquet PARTITIONED BY (bar_month) LOCATION '{self._fresh()}'")
        finally:
            spark.conf.set(IN_CATALOG, was)

    def read(self, spark: SparkSession) -> DataFrame | None:
        return spark.table(self.name).select(*TARGET.fieldNames()) if spark.catalog.tableExists(self.name) else None

    def keys(self, spark: SparkSession, fetch_from: dt.date | None = None) -> DataFrame:
        return self.window(spark, fetch_from).select("symbol", "bar_date")

    def window(self, spark: SparkSession, fetch_from: dt.date | None, values: bool = False) -> DataFrame:
        if not spark.catalog.tableExists(self.name):
            return spark.createDataFrame([], TARGET if values else TARGET_KEYS)
        rows = spark.table(self.name)
        if fetch_from is not None:
            rows = rows.filter((F.col("bar_month") >= F.lit(month_key(fetch_from))) & (F.col("bar_date") >= F.lit(fetch_from)))
        return rows.select(*(TARGET.fieldNames() if values else ("symbol", "bar_date")))

    def write(self, df: DataFrame, mode: str) -> None:
        spark = df.sparkSession
        self.ensure(spark)
        if mode == "overwrite":
            fresh = self._fresh()
            stored_form(df).write.partitionBy("bar_month").parquet(fresh)
            self.switch(spark, fresh)
        else:
            stored_form(df).write.mode("append").partitionBy("bar_month").parquet(self.location(spark))
            spark.catalog.refreshTable(self.name)

    def merge(self, spark: SparkSession, rows: DataFrame, fetch_from: dt.date) -> None:
        merge_months(spark, rows, self.location(spark), fetch_from)
        spark.catalog.refreshTable(self.name)

    def switch(self, spark: SparkSession, folder: str) -> None:
        """Points the table at a complete folder: the one step in which a reload becomes visible."""
        spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(self.name)

    def folders(self, spark: SparkSession) -> list[str]:
        """All load folders, the table's own included."""
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(str(f.getPath().toString()) for f in fs.listStatus(where)) if fs.exists(where) else []

    def clean(self, spark: SparkSession) -> None:
        """Deletes the load folders that the table does not point at."""
        own = self.location(spark).rsplit("/", 1)[-1]
        for folder in self.folders(spark):
            if folder.rsplit("/", 1)[-1] != own:
                remove(spark, folder)


def save_bucketed(keys: DataFrame, name: str, path: str, buckets: int) -> None:
    """A table of the target's keys, dealt into buckets by symbol and day and sorted in them.

    An anti-join on the key then shuffles the incoming rows alone. Buckets by the whole key, not by symbol,
    so that a symbol that holds most of the rows fills all of them.
    """
    dealt = keys.select("symbol", "bar_date").repartition(buckets, "symbol", "bar_date")
    dealt.write.bucketBy(buckets, "symbol", "bar_date").sortBy("symbol", "bar_date").option("path", path).mode("overwrite").saveAsTable(name)
