"""T1: every new landed file is processed once; each micro-batch does the incremental load.

``foreachBatch`` runs bronze -> silver -> anti-join against the target -> gold -> append. There is no
window: every landed day is loaded, however old, unless the target has it. A micro-batch that is
replayed after a failure (the stream commits its offsets after the batch) adds nothing the second
time, because the anti-join sees the rows it already appended; the same holds if the stream's
checkpoint is lost and the whole landing is read again.

Of copies of one key the first loaded stays: if copies with different values fall into different
micro-batches the earlier batch's counts, inside one micro-batch the last fetched. A full reload
takes the last fetched of all, so it differs from the stream where a replay revises a value.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bronze import good_rows, landed_values, rejects_of
from ..operators.silver import to_silver
from ..plans.incremental import load_rows
from ..schemas import LANDING
from ..sinks.audit import write_audit
from ..sinks.tables import log_quality, write_rejects
from ..sinks.targets import Target, as_target

log = logging.getLogger("candlelake.stream")

#: Landed files of a micro-batch: bounds what a batch persists.
MAX_FILES = 1000


def load_batch(batch: DataFrame, target: str | Target, batch_id: int = 0, rejects_path: str | None = None, revise: bool = False, audit_path: str | None = None) -> dict:
    """One micro-batch: keep-last within the batch, look-up in the target from the batch's earliest day on
    (window-pruned), append of the new gold rows; values that cannot be loaded go to the rejects table, once.
    With ``revise`` a batch counts as fetched later than all before it, and its values replace others."""
    spark = batch.sparkSession
    t = as_target(target)
    values = landed_values(batch).persist()  # the batch is read and parsed once
    try:
        rows = good_rows(values)
        earliest, first_run = values.agg(F.min(F.when(F.col("reason").isNull(), F.col("bar_date"))), F.min("run_date")).first()
        if rejects_path and first_run is not None:
            write_rejects(rejects_of(values), rejects_path, runs_from=first_run)
        if earliest is None:
            return {}
        stats = load_rows(spark, to_silver(rows), t, dt.date.fromisoformat(earliest), revise)
        if audit_path:  # a repeated batch replaces its row, whose counts are then those of the repetition
            write_audit(spark, audit_path, f"batch-{batch_id}", "stream", stats)
        log_quality({k: v for k, v in stats.items() if k not in ("latest", "earliest")}, log, f"stream-{batch_id}")
        return stats
    finally:
        values.unpersist()


def start_incremental_stream(
    spark: SparkSession,
    landing_path: str,
    target_path: str | Target,
    checkpoint_path: str,
    max_files_per_trigger: int = MAX_FILES,
    fmt: str = "json",
    available_now: bool = True,
    processing_time: str | None = None,
    rejects_path: str | None = None,
    revise: bool = False,
    audit_path: str | None = None,
) -> StreamingQuery:
    as_target(target_path).ensure(spark)
    src = spark.readStream.schema(LANDING).option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = src.format(fmt).load(landing_path)
    w = stream.writeStream.foreachBatch(lambda df, batch_id: load_batch(df, target_path, batch_id, rejects_path, revise, audit_path) and None).option(
        "checkpointLocation", checkpoint_path
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 hour")
    return w.start()
