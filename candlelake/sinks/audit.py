"""One audit row per load (K5), exact under lost executors and repeated tasks.

Metrics that a job observes while it writes may count a repeated stage twice. An audit row is taken from what
cannot: the persisted rows of an incremental run or micro-batch, or the footers of the files that a reload has
left. Rows are kept by load id in folders of their own, so that a repeated batch replaces its row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.footers import footer_settings
from ..sources.tables import TARGET_STORED

PRICED = ("open", "high", "low", "close", "volume")
COUNTS = ("rows", "n_new", "n_changed", *[f"null_{c}" for c in PRICED])
AUDIT = "kind string, loaded_at timestamp, max_bar_date date, " + ", ".join(f"{c} bigint" for c in COUNTS)


def write_audit(spark: SparkSession, path: str, load_id: str, kind: str, counts: dict) -> None:
    """The audit row of a load, in place of an earlier one with its id. Counts that are not known are NULL."""
    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (kind, at, counts.get("max_bar_date"), *[counts.get(c) for c in COUNTS])
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/load_id={load_id}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All audit rows, with their ``load_id``."""
    return spark.read.schema(f"{AUDIT}, load_id string").parquet(path)


def counted_from_footers(spark: SparkSession, path: str) -> dict:
    """Rows, latest day and NULLs per price column of a stored target, from its file footers.

    A column's NULLs are the rows without its count; no row is read.
    """
    with footer_settings(spark):
        rows = spark.read.schema(TARGET_STORED).parquet(path)
        # decimals have no footer aggregate but their count does
        found = rows.agg(F.count(F.lit(1)).alias("rows"), F.max("bar_date").alias("max_bar_date"), *[F.count(c).alias(f"null_{c}") for c in PRICED]).first().asDict()
    return found | {f"null_{c}": found["rows"] - found[f"null_{c}"] for c in PRICED}
