"""Target writes (K2 full reload, K3 append), metrics observed in the write job (K5), marks (I3)."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import MARKS, REJECTS, TARGET
from ..sources.tables import TARGET_STORED, month_key

LOAD_METRICS = (
    "rows", "max_bar_date", "null_open", "null_high", "null_low", "null_close", "null_volume",
    "duplicate_keys", "violations", "overflows",
)


def load_metrics_of(df: DataFrame, only: Column | None = None) -> list[Column]:
    """The load metrics as aggregates; ``only``: of the rows for which this holds."""
    these = F.lit(True) if only is None else only
    metrics = [
        F.count_if(these).alias("rows"),
        F.max(F.when(these, F.col("bar_date"))).alias("max_bar_date"),
        *[F.count_if(these & F.col(c).isNull()).alias(f"null_{c}") for c in ("open", "high", "low", "close", "volume")],
    ]
    # only what the frame can tell is measured
    if "n_copies" in df.columns:
        metrics.append(F.count_if(these & (F.col("n_copies") > 1)).alias("duplicate_keys"))
    if "violation" in df.columns:
        metrics.append(F.count_if(these & F.col("violation").isNotNull()).alias("violations"))
    if "n_overflow" in df.columns:
        metrics.append(F.coalesce(F.sum(F.when(these, F.col("n_overflow"))), F.lit(0)).cast("bigint").alias("overflows"))
    return metrics


def load_summary(df: DataFrame) -> dict:
    """The load metrics of a frame that is already persisted (one row to the driver)."""
    return df.agg(*load_metrics_of(df)).first().asDict()


def observe_load(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Attach load metrics to the plan; they are computed by the write job itself (no extra
    ``count()`` job, and no re-run of the plan after the write)."""
    obs = Observation(name)
    return df.observe(obs, *load_metrics_of(df)), obs


def observed(obs: Observation, df: DataFrame) -> dict:
    """Metrics of a finished write of ``df``. If a stage has no rows, adaptive execution replaces the
    branch by an empty relation and the metrics go with it; the metrics of no rows are returned then,
    after a look that there are none."""
    try:
        return obs.get
    except (Py4JError, AssertionError):
        if not df.isEmpty():
            raise
        return load_summary(df.limit(0))


def log_quality(metrics: dict, log: logging.Logger, what: str) -> None:
    """One line for each check that was measured (no extra job), as key=value pairs."""
    for name, value in metrics.items():
        if name in ("rows", "max_bar_date"):
            continue
        level = logging.WARNING if value else logging.INFO
        log.log(level, "load=%s check=%s failures=%d result=%s", what, name, value, "FAIL" if value else "PASS")
    log.info("load=%s rows=%d latest=%s", what, metrics.get("rows", 0), metrics.get("max_bar_date"))


def write_rejects(rejects: DataFrame, path: str, mode: str = "append", runs_from: dt.date | None = None) -> dict[str, int]:
    """Adds the rejected values that the table does not hold yet (``overwrite``: replaces it) and
    returns how many of each reason were written. Their digest keeps replays from adding any twice.

    The table is partitioned by run: of what it holds, only the runs from ``runs_from`` on are read, and
    all rejects must be of those. ``rejects`` is read up to three times, so it comes from a persisted parse.
    """
    spark = rejects.sparkSession
    rejects = rejects.dropDuplicates(["reject_id"])
    if mode == "append":
        held = read_rejects(spark, path)
        if held is not None:
            if runs_from is not None:
                held = held.filter((F.col("run_date") >= F.lit(runs_from)) | F.col("run_date").isNull())
            rejects = rejects.join(held.select("reject_id"), "reject_id", "left_anti")
    new = rejects.select(*REJECTS.fieldNames()).persist()
    try:
        counts = {r["reason"]: r["count"] for r in new.groupBy("reason").count().collect()}  # one row per reason
        if mode == "overwrite":
            replace_table(new, path, "run_date")
        elif counts:
            new.write.mode("append").partitionBy("run_date").parquet(path)
        return counts
    finally:
        new.unpersist()


def read_rejects(spark: SparkSession, path: str) -> DataFrame | None:
    """The table of rejects; None if there is none yet."""
    try:
        return spark.read.schema(REJECTS).parquet(path).select(*REJECTS.fieldNames())
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or ""):
            return None
        raise


def replace_table(df: DataFrame, path: str, *partition: str) -> None:
    """Writes the new table beside the old one and swaps the folders, so that a job that fails midway
    leaves the old table as it was."""
    spark = df.sparkSession
    fresh, old = (f"{path.rstrip('/')}__{kind}-{uuid.uuid4().hex[:8]}" for kind in ("new", "old"))
    writer = df.write.partitionBy(*partition) if partition else df.write
    writer.parquet(fresh)
    jvm = spark.sparkContext._jvm
    where, was, now = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, old, fresh))
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.exists(where)
    if held and not fs.rename(where, was):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(now, where):
        if held:
            fs.rename(was, where)
        raise OSError(f"cannot put {fresh} in place of {path}")
    if held:
        fs.delete(was, True)
    spark.catalog.refreshByPath(path)


def write_target(df: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet target, partitioned by month of ``bar_date`` (folders prune the key scans of later
    runs). A rebalance on the month gives each month few files, sorted by key for tight
    row-group statistics; adaptive execution splits a month that holds most of the rows over
    several tasks and merges small ones (no sampling pass over the input, unlike a range
    repartition). ``overwrite`` is a full reload: the new table is written first, then swapped in."""
    out = stored_form(df)
    if mode == "overwrite":
        replace_table(out, path, "bar_month")
    else:
        out.write.mode(mode).partitionBy("bar_month").parquet(path)


def stored_form(df: DataFrame) -> DataFrame:
    """The target's columns and the month that its folders are named by, dealt out and sorted for writing."""
    out = df.select(*TARGET.fieldNames()).withColumn("bar_month", F.date_format("bar_date", "yyyy-MM"))
    return out.hint("rebalance", "bar_month").sortWithinPartitions("bar_month", "symbol", "bar_date")


def merge_months(spark: SparkSession, rows: DataFrame, path: str, fetch_from: dt.date) -> None:
    """Puts ``rows`` (of ``fetch_from`` or later) into the target in place of those with the same keys.

    The months that they touch are written to a folder beside the table first, with the rows of
    these months that stay; then they replace the table's folders of these months (dynamic partition overwrite).
    Other months are neither read nor written. The touched months are found by a semi-join, not listed.
    """
    new = rows.select(*TARGET.fieldNames()).withColumn("bar_month", F.date_format("bar_date", "yyyy-MM"))
    held = spark.read.schema(TARGET_STORED).parquet(path).filter(F.col("bar_month") >= F.lit(month_key(fetch_from)))
    held = held.join(new.select("bar_month").distinct(), "bar_month", "left_semi").join(new.select("symbol", "bar_date"), ["symbol", "bar_date"], "left_anti")
    staged = f"{path.rstrip('/')}__merge-{uuid.uuid4().hex[:8]}"
    stored_form(held.unionByName(new)).write.partitionBy("bar_month").parquet(staged)
    ready = spark.read.schema(TARGET_STORED).parquet(staged)
    ready.hint("rebalance", "bar_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bar_month").parquet(path)
    remove(spark, staged)
    spark.catalog.refreshByPath(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a load has made for itself."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    mode: str = "append",
    num_partitions: int | None = None,
    batch_size: int = 10000,
) -> None:
    """JDBC load. A full reload truncates instead of dropping the table, so the key, DECIMAL
    and domain definitions of the target survive. Each partition commits on its own, so an
    append is not atomic: the next incremental run's anti-join picks up what is missing."""
    w = df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **properties)
    if mode == "overwrite":
        w = w.option("truncate", "true")
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.mode(mode).save()


def ensure_marks(spark: SparkSession, path: str) -> None:
    """An empty marks table if there is none yet (save mode "ignore")."""
    spark.createDataFrame([], MARKS).write.mode("ignore").parquet(path)


def append_mark(spark: SparkSession, path: str, last_loaded_date: dt.date) -> None:
    """Record the high-water mark after a successful load (append-only, one row per run)."""
    row = [(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), last_loaded_date, None)]
    spark.createDataFrame(row, MARKS).coalesce(1).write.mode("append").parquet(path)


def append_symbol_marks(loaded: DataFrame, path: str) -> None:
    """Record one mark per symbol: ``max(bar_date)`` per symbol of the rows now in the target
    (one partial aggregate; the table grows by the number of symbols per run)."""
    marks = loaded.groupBy("symbol").agg(F.max("bar_date").alias("last_loaded_date"))
    marks.select(
        F.current_timestamp().cast("timestamp").alias("loaded_at"), "last_loaded_date", "symbol"
    ).write.mode("append").parquet(path)
