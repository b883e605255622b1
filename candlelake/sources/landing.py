"""Landing zone of raw API responses (sink K1 and scan S1).

Format of record: JSON lines, one response per line, ``symbol, fetched_at, http_status, body``,
partitioned by ``run_date``. Every run is appended, so transforms can be replayed from any run,
and a scan restricted to recent runs prunes whole partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LANDING


def write_landing(landing: DataFrame, path: str, fmt: str = "json") -> None:
    """Append landed responses, one folder per run date (a rebalance: few files per run, and a
    run holding most of the rows is split over several tasks).

    ``fmt``: "json" (JSON lines, the readable default) or "parquet" (the body stays raw text;
    compressed and faster to scan at volume).
    """
    (
        landing.select(*LANDING.fieldNames())
        .hint("rebalance", "run_date")
        .write.mode("append")
        .partitionBy("run_date")
        .format(fmt)
        .save(path)
    )


def read_landing(spark: SparkSession, path: str, runs_from: dt.date | None = None, fmt: str = "json") -> DataFrame:
    """Scan landed responses with the fixed schema; ``runs_from`` prunes older run folders."""
    df = spark.read.schema(LANDING).format(fmt).load(path)
    if runs_from is not None:
        df = df.filter(F.col("run_date") >= F.lit(runs_from))
    return df


def read_merged_documents(spark: SparkSession, path: str) -> DataFrame:
    """Compatibility scan of merged documents ``{"SYM": {...}, "SYM2": {...}}`` (one per file).

    Each file is one task and one string, so this is for small legacy files only; the JSON-lines
    landing above is the scalable format. A symbol repeated in one file keeps its last body.
    """
    from ..functions.jsonmaps import entries_by_key, last_per_key

    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_modification_time").alias("fetched_at"),
        entries_by_key(F.from_json("value", "map<string,string>")).alias("entries"),
    )
    docs = raw.select("fetched_at", F.explode(last_per_key(F.col("entries"))).alias("e"))
    return docs.select(
        F.col("e.key").alias("symbol"),
        "fetched_at",
        F.lit(200).alias("http_status"),
        F.col("e.value").alias("body"),
        F.to_date("fetched_at").alias("run_date"),
    )
