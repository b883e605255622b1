"""Incremental load (C2, C3, I1-I4).

mark -> fetch window -> landing scan (old run folders pruned) -> one parse of what landed -> window
filter, keep-last -> look-up of each key in the target (window-pruned) -> gold -> conform -> append ->
advance the mark. A run ends early when nothing landed, when no landed value is a row of the
window, or when the target holds all of them; only then nothing is written. After a load or a
look that finds everything there, the target holds every incoming key, so the mark is taken from
the incoming rows: a run that died between append and mark is made good by the next one.

Of copies of one key the first loaded stays (the target is never updated); inside one run the last
fetched counts. With ``revise`` a copy of the window whose values differ replaces the loaded one. Values
that cannot be loaded go to the rejects table, if one is named; a day after its run is one of them, so that
no such date ever becomes the mark.

Run folders: a response cannot be older than the days it holds, so runs dated before the window
have no day of it and are not read.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FIRST_RUN_DAYS, LOOKBACK_DAYS
from ..operators.bronze import good_rows, landed_values, rejects_of
from ..operators.conform import conform
from ..operators.coverage import in_gaps
from ..operators.gold import to_gold
from ..operators.incremental import fetch_window, in_window, in_window_per_symbol, per_symbol_marks, with_state
from ..operators.silver import to_silver
from ..session import work_dir
from ..sinks.audit import write_audit
from ..sinks.tables import append_mark, append_symbol_marks, ensure_marks, load_metrics_of, log_quality, write_rejects
from ..sinks.targets import Target, as_target
from ..sources.landing import read_landing
from ..sources.tables import read_marks


log = logging.getLogger("candlelake.incremental")


def per_symbol_marks_of(spark: SparkSession, marks_path: str, target: Target) -> DataFrame:
    """Latest mark per symbol from the marks table (small: symbols x runs). Before any
    per-symbol mark was recorded, they are derived once from the target's keys."""
    marks = read_marks(spark, marks_path).filter(F.col("symbol").isNotNull())
    if not marks.isEmpty():
        return marks.groupBy("symbol").agg(F.max("last_loaded_date").alias("last_loaded_date"))
    loaded = target.read(spark)
    if loaded is None:
        return spark.createDataFrame([], "symbol string, last_loaded_date date")
    # Checkpointed (into spark.checkpoint.dir) so that nothing later depends on the target's
    # files, which this run appends to.
    work_dir(spark)
    return per_symbol_marks(loaded).checkpoint()


def load_rows(spark: SparkSession, incoming: DataFrame, target: Target, scan_from: dt.date | None, revise: bool) -> dict:
    """Loads the rows of ``incoming`` that the target lacks and, with ``revise``, those whose values differ.

    Returns the counts of one pass: n_incoming, n_new, n_matched, n_changed, latest and earliest day, metrics of what is written.
    """
    extra = ("n_copies", "n_overflow")
    gold = conform(to_gold(incoming, *extra), *extra)
    gold = with_state(gold, target.window(spark, scan_from, values=revise), revise).persist()
    try:
        write = F.col("state") != F.lit("same")
        counts = [F.count(F.lit(1)).alias("n_incoming"), *[F.count_if(F.col("state") == k).alias(f"n_{k}") for k in ("new", "changed")]]
        days = [F.max("bar_date").alias("latest"), F.min("bar_date").alias("earliest")]
        stats = gold.agg(*counts, *days, *load_metrics_of(gold, write)).first().asDict()
        stats["n_matched"] = stats["n_incoming"] - stats["n_new"]
        if stats["n_changed"]:
            target.merge(spark, gold.filter(write), stats["earliest"])
        elif stats["rows"]:
            target.write(gold.filter(write), mode="append")
        return stats
    finally:
        gold.unpersist()


def run_incremental(
    spark: SparkSession,
    landing_path: str,
    target_path: str | Target,
    marks_path: str,
    as_of: dt.date,
    lookback_days: int = LOOKBACK_DAYS,
    per_key: bool = False,
    fmt: str = "json",
    first_run_days: int = FIRST_RUN_DAYS,
    rejects_path: str | None = None,
    revise: bool = False,
    gaps: DataFrame | None = None,
    audit_path: str | None = None,
    load_id: str | None = None,
) -> dict:
    """One run. ``outcome``: nothing_landed, nothing_in_window, nothing_new or loaded; a first run has a window too, the last ``first_run_days`` days.

    n_incoming, n_matched, n_new: rows of the window, those that the target holds, those that it lacks; n_changed: rows that replaced
    others (``revise``); n_outside: landed days of the scanned runs that are not in the window. ``gaps`` (rows of
    ``coverage_gaps``): the run takes just the days of these gaps, whatever their age, instead of the window. ``audit_path``: an
    audit row of a run that found rows in its window, from the persisted rows.
    """
    target = as_target(target_path)
    target.ensure(spark)  # first run: an empty target, so every landed row is new
    ensure_marks(spark, marks_path)
    marks = read_marks(spark, marks_path)
    old_mark, _, fetch_from = fetch_window(spark, marks, as_of, lookback_days, first_run_days).first()
    scan_from, symbol_marks = fetch_from, None
    if gaps is not None:
        scan_from = gaps.agg(F.min("from_date")).first()[0] or as_of
    elif per_key:
        symbol_marks = per_symbol_marks_of(spark, marks_path, target)
        floor = as_of - dt.timedelta(days=first_run_days)
        scan_from = min(fetch_from, floor)

    landing = read_landing(spark, landing_path, runs_from=scan_from, fmt=fmt)
    values = landed_values(landing)
    result = {"fetch_from": fetch_from, "old_mark": old_mark, "new_mark": old_mark, "new_rows": 0}
    values = values.persist()  # what the scanned runs hold: parsed once for rows, rejects and counts
    try:
        if rejects_path:
            result["rejects"] = write_rejects(rejects_of(values), rejects_path, runs_from=scan_from)
        silver = to_silver(good_rows(values))
        if gaps is not None:
            incoming = in_gaps(silver, gaps)
        elif symbol_marks is not None:
            incoming = in_window_per_symbol(silver, symbol_marks, floor, lookback_days)
        else:
            incoming = in_window(silver, fetch_from)
        stats = load_rows(spark, incoming, target, scan_from, revise)
        result |= {k: stats.pop(k) for k in ("n_incoming", "n_matched", "n_new", "n_changed")}
        result["new_rows"] = result["n_new"]
        latest, _ = stats.pop("latest"), stats.pop("earliest")
        if gaps is None and not per_key:
            outside = values.filter(F.col("reason").isNull() & (F.col("bar_date") < F.lit(fetch_from.isoformat())))
            result["n_outside"] = outside.count()
        if result["n_incoming"] == 0:
            result["outcome"] = "nothing_landed" if landing.isEmpty() else "nothing_in_window"
            return result
        if audit_path:
            write_audit(spark, audit_path, load_id or uuid.uuid4().hex, "incremental", result | stats)
        result |= {f"new_{k}": v for k, v in stats.items() if k != "rows"}
        result["outcome"] = "loaded" if stats["rows"] else "nothing_new"
        if stats["rows"]:
            if per_key:
                # not from the look-up's rows: the write has changed what those depend on
                append_symbol_marks(incoming, marks_path)
            log_quality(stats, log, "incremental")
        if latest is not None and (old_mark is None or latest > old_mark):  # the mark never moves back
            append_mark(spark, marks_path, latest)
            result["new_mark"] = latest
        return result
    finally:
        log.info("incremental: %s", result)
        values.unpersist()
