"""T2: the lookback as late-data handling.

Days are stamped with their date (as a timestamp) as event time. A 2-day watermark drops days
older than the newest seen day minus two days (late), and ``dropDuplicatesWithinWatermark``
drops a replayed (symbol, day) while it is still within the watermark. State for a key is kept
only until the watermark passes it, so state stays bounded by the window, not by history.

What is late depends on what was seen before, hence on how files fall into micro-batches: this
stream is for landings that arrive in order. Days that come late are lost to it by design; the
incremental stream (T1) loads them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import KEY, LOOKBACK_DAYS
from ..operators.bronze import good_rows, landed_values
from ..operators.silver import parse
from ..schemas import BRONZE_COLUMNS, LANDING


def start_late_dedup_stream(
    spark: SparkSession,
    landing_path: str,
    out_path: str,
    checkpoint_path: str,
    delay: str = f"{LOOKBACK_DAYS} days",
    max_files_per_trigger: int | None = None,
    fmt: str = "json",
) -> StreamingQuery:
    src = spark.readStream.schema(LANDING)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", str(max_files_per_trigger))
    days = parse(good_rows(landed_values(src.format(fmt).load(landing_path)))).select(
        *BRONZE_COLUMNS, F.col("bar_date").cast("timestamp").alias("event_time")
    )
    deduped = days.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(KEY))
    return (
        deduped.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
