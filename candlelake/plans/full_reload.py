"""Full reload (C1): landing -> bronze -> silver -> gold -> conform -> overwrite the target.

One lazily composed plan and one write job; quality and load metrics are observed inside it
(the reference ran ten separate actions over the same uncached lineage).
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.bronze import good_rows, landed_values, rejects_of
from ..operators.conform import conform
from ..operators.gold import to_gold
from ..operators.silver import to_silver
from ..sinks.audit import counted_from_footers, write_audit
from ..sinks.tables import log_quality, observe_load, observed, write_rejects
from ..sinks.targets import Target, as_target


log = logging.getLogger("candlelake.full_reload")


def run_full_reload(spark: SparkSession, landing: DataFrame, target: str | Target, rejects_path: str | None = None, audit_path: str | None = None, load_id: str | None = None) -> dict:
    """``target``: a Parquet folder or a target object (JDBC truncates instead of dropping). Of copies
    of one key the last fetched counts. ``rejects_path``: table of the values that cannot be loaded,
    replaced by this run's; its counts per reason are returned as ``rejects``. With it the parsed values are
    persisted (they may spill to disk), so that rows and rejects come from one parse. ``audit_path``: an audit row, from the
    footers of the written files."""
    return reload_values(spark, landed_values(landing), target, rejects_path, audit_path, load_id)


def reload_values(spark: SparkSession, values: DataFrame, target: str | Target, rejects_path: str | None = None, audit_path: str | None = None, load_id: str | None = None) -> dict:
    """The same from landed values (``bronze.landed_values``, or those of merged documents)."""
    # n_copies and n_overflow ride along so the checks are observed in the same write job
    extra = ("n_copies", "n_overflow")
    target = as_target(target)
    if rejects_path:
        values = values.persist()
    gold = conform(to_gold(to_silver(good_rows(values)), *extra), *extra)
    to_write, obs = observe_load(gold, "full_reload")
    try:
        target.write(to_write, mode="overwrite")
        metrics = observed(obs, gold)
        counts = write_rejects(rejects_of(values), rejects_path, "overwrite") if rejects_path else None
    finally:
        values.unpersist()
    if audit_path:
        exact = counted_from_footers(spark, target.folder(spark))
        write_audit(spark, audit_path, load_id or uuid.uuid4().hex, "full_reload", exact | {"n_new": exact["rows"], "n_changed": 0})
        metrics |= {k: v for k, v in exact.items() if k in metrics}
    log_quality(metrics | {f"reject_{k}": v for k, v in (counts or {}).items()}, log, "full_reload")
    return {"outcome": "loaded", **metrics, **({} if counts is None else {"rejects": counts})}
