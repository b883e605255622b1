"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All of them start from the driver's tables (orders, customer) and run the whole tables:
orders -> bars -> landed responses -> bronze -> silver -> gold, plus the incremental scenario
below. Queries that load a table write under the session's shared work folder
(``spark.checkpoint.dir``) and return the table read back.

Incremental scenario, derived from the data: ``d_max`` = latest bar date, ``cut`` = d_max - 30
days. The existing target holds the gold rows before ``cut`` except the days
[cut - 5, cut) of the alphabetically first symbol (a partial load that failed). The mark is the
target's latest date; the run's ``as_of`` is d_max.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import ERROR_KEY, INFO_KEY, LOOKBACK_DAYS, REJECT_BODY, REJECT_DATE, REJECT_DAY, REJECT_FUTURE, REJECT_SYMBOL, SERIES_KEY
from .operators import bronze as B
from .operators import conform as C
from .operators import coverage as V
from .operators import gold as G
from .operators import incremental as I
from .operators import reconcile as R2
from .operators import reports as R
from .operators import silver as S
from .plans import run_full_reload, run_incremental
from .schemas import BRONZE_COLUMNS, RAW_MAP, TARGET
from .session import new_path
from .sinks.audit import read_audit
from .sinks.catalog import CatalogTarget, save_bucketed
from .sinks.tables import LOAD_METRICS, append_mark, ensure_marks, read_rejects, stored_form, write_target
from .sinks.targets import ParquetTarget
from .sources import fixtures as X
from .sources.footers import months_from_footers
from .sources.landing import read_landing, write_landing
from .sources.merged import merged_values
from .sources.tables import existing_keys as scan_existing_keys
from .sources.tables import read_marks, read_target
from .streaming import start_incremental_stream, start_late_dedup_stream, start_late_rows_stream

# Lookback and first-run length that take in every day.
ALL_DAYS = 100_000
PER_KEY_LATE, PER_KEY_DEAD, LATE_DAYS = 30, 400, 400
CUT_DAYS = 30
HOLE_DAYS = 5
TARGET_COLUMNS = tuple(TARGET.fieldNames())


# --- medallion chain over the driver's tables ----------------------------------------------------


def bars(spark: SparkSession, sf: str) -> DataFrame:
    return X.orders_bars(spark, sf)


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """For the symbols and days of the bars."""
    return X.orders_ticks(spark, sf)


def landing(spark: SparkSession, sf: str) -> DataFrame:
    return X.landing_from_bars(bars(spark, sf))


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return B.flatten(landing(spark, sf))


def silver_all(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed, before keep-last (replays still present) - what the quality checks see."""
    return S.parse(bronze(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return S.to_silver(bronze(spark, sf)).select(*BRONZE_COLUMNS)


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return G.to_gold(silver(spark, sf))


# --- incremental scenario ----------------------------------------------------------------------


class Scenario:
    def __init__(self, spark: SparkSession, sf: str):
        row = ticks(spark, sf).agg(F.max("bar_date").alias("d"), F.min("symbol").alias("s")).first()
        self.d_max: dt.date = row["d"]
        self.hole_symbol: str = row["s"]
        self.cut = self.d_max - dt.timedelta(days=CUT_DAYS)
        self.hole_from = self.cut - dt.timedelta(days=HOLE_DAYS)
        self.spark, self.sf = spark, sf
        self._mark: dt.date | None = None
        self.silver = silver(spark, sf)

    def _existing_filter(self, df: DataFrame) -> DataFrame:
        hole = (F.col("symbol") == F.lit(self.hole_symbol)) & (F.col("bar_date") >= F.lit(self.hole_from))
        return df.filter((F.col("bar_date") < F.lit(self.cut)) & ~hole)

    def existing(self) -> DataFrame:
        return self._existing_filter(G.to_gold(self.silver))

    def stored_target(self) -> DataFrame:
        """The existing target as the loaders see it: a stored table, written once."""
        return read_target(self.spark, self.setup(land=False)["target"])

    def mark(self) -> DataFrame:
        return self.existing().agg(F.max("bar_date").alias("last_loaded_date"))

    def mark_value(self) -> dt.date:
        """The target's latest day. Every bar lands, so it is taken from the bars (one cheap
        aggregate, computed once)."""
        if self._mark is None:
            self._mark = I.first_value(
                self._existing_filter(ticks(self.spark, self.sf)).agg(F.max("bar_date").alias("m")), "m"
            )
        return self._mark

    def fetch_from(self) -> dt.date:
        return self.mark_value() - dt.timedelta(days=LOOKBACK_DAYS)

    def setup(self, land: bool = True) -> dict[str, str]:
        """Land every run (unless ``land`` is False), load the existing target, record its mark."""
        paths = {k: new_path(self.spark, k) for k in ("landing", "target", "marks")}
        if land:
            write_landing(landing(self.spark, self.sf), paths["landing"])
        write_target(C.conform(self.existing()), paths["target"], mode="overwrite")
        target = read_target(self.spark, paths["target"])
        append_mark(self.spark, paths["marks"], I.first_value(target.agg(F.max("bar_date").alias("m")), "m"))
        return paths

    def run(self, paths: dict[str, str], **kw) -> dict:
        return run_incremental(self.spark, paths["landing"], paths["target"], paths["marks"], self.d_max, **kw)


def _target(spark: SparkSession, path: str) -> DataFrame:
    return read_target(spark, path).select(*TARGET_COLUMNS)


def _one_row(spark: SparkSession, values: dict, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(values[f.name] for f in schema.fields)], schema)


# --- queries -------------------------------------------------------------------------------------


def q_envelope_status(spark, sf):
    return B.classify(landing(spark, sf)).select("symbol", "run_date", "http_status", "status")


def q_bronze_flatten(spark, sf):
    return bronze(spark, sf).select(*BRONZE_COLUMNS, "run_date")


def q_json_key_last_wins(spark, sf):
    return B.entry_counts(landing(spark, sf))


def q_landing_merge(spark, sf):
    return B.merge_attempts(landing(spark, sf))


def q_landing_roundtrip(spark, sf):
    path = new_path(spark, "landing")
    write_landing(landing(spark, sf), path)
    return B.flatten(read_landing(spark, path)).select(*BRONZE_COLUMNS, "run_date")


def q_scalar_functions(spark, sf):
    outer = F.from_json("body", RAW_MAP)
    series = F.from_json(F.col("outer")[SERIES_KEY], RAW_MAP)
    lnd = landing(spark, sf).select("symbol", "run_date", "http_status", outer.alias("outer"))
    return lnd.select(
        "symbol",
        "run_date",
        "http_status",
        F.coalesce(F.map_contains_key("outer", INFO_KEY), F.lit(False)).alias("has_information"),
        F.coalesce(F.map_contains_key("outer", ERROR_KEY), F.lit(False)).alias("has_error_message"),
        F.coalesce(F.size("outer"), F.lit(0)).alias("n_keys"),
        F.coalesce(F.size(series), F.lit(0)).alias("n_series_entries"),
        F.date_format("run_date", "yyyy-MM-dd").alias("run_label"),
        F.try_to_date(F.date_format("run_date", "yyyy-MM-dd"), "yyyy-MM-dd").alias("run_parsed"),
        F.date_sub("run_date", LOOKBACK_DAYS).alias("lookback_from"),
        F.to_json(F.struct("symbol", "http_status")).alias("as_json"),
    )


def q_silver_parse(spark, sf):
    return silver_all(spark, sf).select(*BRONZE_COLUMNS, "run_date")


def q_null_counts(spark, sf):
    return S.null_counts(silver_all(spark, sf))


def q_duplicate_keys(spark, sf):
    return S.duplicate_keys(silver_all(spark, sf))


def q_dq_report(spark, sf):
    return S.dq_report(silver_all(spark, sf))


def q_gold_bars(spark, sf):
    return gold(spark, sf)


def q_candle_edges(spark, sf):
    return G.candle_edges(silver(spark, sf))


def q_conform_target(spark, sf):
    return C.conform(gold(spark, sf))


def q_fetch_window(spark, sf):
    sc = Scenario(spark, sf)
    return I.fetch_window(spark, sc.mark(), sc.d_max)


def q_fetch_window_first_run(spark, sf):
    sc = Scenario(spark, sf)
    marks = new_path(spark, "marks")
    ensure_marks(spark, marks)  # no mark recorded yet
    return I.fetch_window(spark, read_marks(spark, marks), sc.d_max)


def q_lookback_window(spark, sf):
    sc = Scenario(spark, sf)
    return I.in_window(sc.silver, sc.fetch_from())


def q_window_counts(spark, sf):
    sc = Scenario(spark, sf)
    return I.window_counts(sc.silver, sc.fetch_from())


def q_existing_keys(spark, sf):
    """The whole target's keys; the window-pruned scan of a run is part of ``incremental_append``."""
    return scan_existing_keys(spark, Scenario(spark, sf).setup(land=False)["target"])


def q_new_rows(spark, sf):
    """A full re-fetch (all history) against the existing target."""
    sc = Scenario(spark, sf)
    return I.new_rows(sc.silver, sc.stored_target().select("symbol", "bar_date"))


def q_new_rows_first_run(spark, sf):
    target = ParquetTarget(new_path(spark, "target"))
    target.ensure(spark)  # first run: the target is bootstrapped empty
    return I.new_rows(silver(spark, sf), target.keys(spark))


def q_incremental_summary(spark, sf):
    sc = Scenario(spark, sf)
    incoming = I.in_window(sc.silver, sc.fetch_from())
    return I.incremental_summary(incoming, sc.stored_target().select("symbol", "bar_date"), window_from=sc.fetch_from())


def _window_new(sc: Scenario, target: DataFrame) -> DataFrame:
    incoming = I.in_window(sc.silver, sc.fetch_from())
    return I.new_rows(incoming, target.select("symbol", "bar_date"))


def q_max_loaded_date(spark, sf):
    sc = Scenario(spark, sf)
    return I.max_loaded_date(_window_new(sc, sc.stored_target()))


def q_advance_mark(spark, sf):
    sc = Scenario(spark, sf)
    paths = sc.setup(land=False)
    return I.advance_mark(read_marks(spark, paths["marks"]), _window_new(sc, read_target(spark, paths["target"])))


def q_full_reload(spark, sf):
    path = new_path(spark, "target")
    run_full_reload(spark, landing(spark, sf), path)
    return _target(spark, path)


def q_landing_winner(spark, sf):
    won = B.winning_responses(landing(spark, sf))
    entries = F.size(F.from_json(F.from_json("body", RAW_MAP)[SERIES_KEY], RAW_MAP))  # repeated days count
    return won.select("symbol", "run_date", "http_status", "status", entries.alias("n_series_entries"))


def rough_landing(spark: SparkSession, sf: str, d_max: dt.date) -> DataFrame:
    return landing(spark, sf).unionByName(X.rough_responses(ticks(spark, sf), d_max, revisions=False))


def q_rejected_rows(spark, sf):
    sc = Scenario(spark, sf)
    return B.rejects(rough_landing(spark, sf, sc.d_max)).select("symbol", "run_date", "bar_date", "reason")


def q_dq_report_rejects(spark, sf):
    sc = Scenario(spark, sf)
    return S.dq_report(S.parse(B.flatten(rough_landing(spark, sf, sc.d_max))))


def q_load_paths_agree(spark, sf):
    """The three load paths over one rough landing, in two steps: everything, then a run that revises
    one day. The reload takes the last fetched copy; the incremental run and the stream keep the
    first loaded one. All else agrees, rejects included."""
    sc = Scenario(spark, sf)
    as_of = sc.d_max + dt.timedelta(days=50)
    lpath, marks, ckpt = (new_path(spark, k) for k in ("landing", "marks", "stream-checkpoint"))
    targets = {k: new_path(spark, "target") for k in ("reload", "incremental", "stream")}
    rejected = {k: new_path(spark, "rejects") for k in targets}

    def both() -> None:
        run_incremental(spark, lpath, targets["incremental"], marks, as_of, first_run_days=ALL_DAYS, lookback_days=ALL_DAYS, rejects_path=rejected["incremental"])
        start_incremental_stream(spark, lpath, targets["stream"], ckpt, rejects_path=rejected["stream"]).awaitTermination()

    write_landing(rough_landing(spark, sf, sc.d_max), lpath)
    both()
    write_landing(X.rough_responses(ticks(spark, sf), sc.d_max, revisions=True), lpath)
    both()
    run_full_reload(spark, read_landing(spark, lpath), targets["reload"], rejected["reload"])
    out = []
    for k in targets:
        reasons = [F.count_if(F.col("reason") == r).cast("bigint").alias(f"n_{r}") for r in (REJECT_BODY, REJECT_DAY, REJECT_DATE, REJECT_SYMBOL)]
        bad = spark.read.parquet(rejected[k]).agg(*reasons).withColumn("load_path", F.lit(k))
        good = _target(spark, targets[k]).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("symbol", "bar_date").alias("n_keys"),
            F.sum("close").cast("decimal(38,4)").alias("sum_close"), F.max("bar_date").alias("latest"),
        ).withColumn("load_path", F.lit(k))
        out.append(good.join(bad, "load_path"))
    return reduce(DataFrame.unionByName, out)


def q_per_key_recovery(spark, sf):
    """Per-symbol marks: the first symbol is late by PER_KEY_LATE days, the second has been silent for
    longer than the first-run window, the third is new. What the run appends."""
    sc = Scenario(spark, sf)
    late, dead, fresh = [r["symbol"] for r in ticks(spark, sf).select("symbol").distinct().orderBy("symbol").limit(3).collect()]
    paths = {k: new_path(spark, k) for k in ("landing", "target", "marks")}
    write_landing(landing(spark, sf), paths["landing"])
    s, d = F.col("symbol"), F.col("bar_date")
    held = (
        F.when(s == late, d < F.lit(sc.cut - dt.timedelta(days=PER_KEY_LATE)))
        .when(s == dead, d < F.lit(sc.d_max - dt.timedelta(days=PER_KEY_DEAD)))
        .when(s == fresh, F.lit(False))
        .otherwise(d < F.lit(sc.cut))
    )
    write_target(C.conform(G.to_gold(sc.silver).filter(held)), paths["target"], mode="overwrite")
    before = _target(spark, paths["target"]).select("symbol", "bar_date")
    append_mark(spark, paths["marks"], I.first_value(before.agg(F.max("bar_date").alias("m")), "m"))
    before = before.checkpoint()
    sc.run(paths, per_key=True)
    return I.new_rows(_target(spark, paths["target"]), before).select("symbol", "bar_date", "close")


def q_early_exits(spark, sf):
    """How a run ends: nothing landed; only failed responses landed; rows landed and loaded; the same
    again."""
    sc = Scenario(spark, sf)
    every = landing(spark, sf)
    empty, failed, good = (new_path(spark, "landing") for _ in range(3))
    write_landing(every.limit(0), empty)
    write_landing(every.filter(F.col("body").isNull() | ~F.col("body").contains(SERIES_KEY)), failed)
    write_landing(every, good)
    target, marks = new_path(spark, "target"), new_path(spark, "marks")
    rows = []
    for case, path in (("empty", empty), ("failed", failed), ("good", good), ("again", good)):
        r = run_incremental(spark, path, target, marks, sc.d_max, first_run_days=ALL_DAYS)
        rows.append((case, r["outcome"], r["new_rows"], r["new_mark"]))
    return spark.createDataFrame(rows, "step string, outcome string, n_new bigint, mark date")


LOAD_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("max_bar_date", T.DateType()),
        *[T.StructField(m, T.LongType()) for m in LOAD_METRICS[2:]],  # nulls, duplicates, violations
    ]
)


def q_load_metrics(spark, sf):
    metrics = run_full_reload(spark, landing(spark, sf), new_path(spark, "target"))
    return _one_row(spark, metrics, LOAD_METRICS_SCHEMA)


def q_incremental_append(spark, sf):
    sc = Scenario(spark, sf)
    paths = sc.setup()
    sc.run(paths)
    return _target(spark, paths["target"])


def q_replay_idempotent(spark, sf):
    sc = Scenario(spark, sf)
    paths = sc.setup()
    first = sc.run(paths)
    second = sc.run(paths)
    t = _target(spark, paths["target"])
    return t.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("symbol", "bar_date").alias("n_keys"),
    ).select(
        "n_rows",
        "n_keys",
        F.lit(first["new_rows"]).cast("bigint").alias("appended_first"),
        F.lit(second["new_rows"]).cast("bigint").alias("appended_second"),
    )


def q_incremental_noop(spark, sf):
    sc = Scenario(spark, sf)
    paths = sc.setup()
    first = sc.run(paths)
    second = sc.run(paths)
    schema = T.StructType(
        [
            T.StructField("outcome", T.StringType()),
            T.StructField("n_new", T.LongType()),
            T.StructField("mark_before", T.DateType()),
            T.StructField("mark_after", T.DateType()),
        ]
    )
    mark_after = I.first_value(read_marks(spark, paths["marks"]).agg(F.max("last_loaded_date").alias("m")), "m")
    row = {"outcome": second["outcome"], "n_new": second["new_rows"], "mark_before": first["new_mark"], "mark_after": mark_after}
    return _one_row(spark, row, schema)


def q_partial_load_recovery(spark, sf):
    sc = Scenario(spark, sf)
    paths = sc.setup()
    before = _target(spark, paths["target"]).select("symbol", "bar_date")
    result = sc.run(paths)
    appended = I.new_rows(_target(spark, paths["target"]), before)
    return appended.select(
        "symbol", "bar_date", (F.col("bar_date") <= F.lit(result["old_mark"])).alias("recovered")
    )


def q_table_scan(spark, sf):
    return X.employees(spark, sf)


def q_ordered_scan(spark, sf):
    return R.ordered_scan(X.employees(spark, sf), "id")


def q_fixed_width_report(spark, sf):
    return R.fixed_width_report(R.ordered_scan(X.employees(spark, sf), "id"))


def q_labelled_report(spark, sf):
    return R.labelled_report(X.employees(spark, sf))


def q_row_count(spark, sf):
    return (
        R.row_count(gold(spark, sf), "gold")
        .unionByName(R.row_count(X.employees(spark, sf), "employees"))
        .unionByName(R.row_count(landing(spark, sf), "landing"))
    )


def q_rows_per_symbol(spark, sf):
    return R.rows_per_symbol(gold(spark, sf))


def q_latest_per_symbol(spark, sf):
    return R.latest_per_symbol(gold(spark, sf))


def q_latest_bars_topk(spark, sf):
    return R.latest_bars(gold(spark, sf), 10).select("symbol", "bar_date", "close", "candle")


def q_preview(spark, sf):
    return R.preview(gold(spark, sf), 5)


def q_stream_incremental(spark, sf):
    lpath, tpath, cpath = (new_path(spark, k) for k in ("landing", "target", "stream-checkpoint"))
    write_landing(landing(spark, sf), lpath)
    q = start_incremental_stream(spark, lpath, tpath, cpath)
    q.awaitTermination()
    return _target(spark, tpath)


def q_stream_dedup_late(spark, sf):
    lpath, opath, cpath = (new_path(spark, k) for k in ("landing", "dedup", "stream-checkpoint"))
    write_landing(landing(spark, sf), lpath)
    q = start_late_dedup_stream(spark, lpath, opath, cpath)
    q.awaitTermination()
    return spark.read.parquet(opath).select(*BRONZE_COLUMNS)


def q_stream_late_rows(spark, sf):
    """The watermark at work: everything lands and is read, then one more run brings an old day and a new
    one. What the stream keeps, and (``late``) what it loses because the old day came too late."""
    sc = Scenario(spark, sf)
    lpath, opath, cpath = (new_path(spark, k) for k in ("landing", "dedup", "stream-checkpoint"))
    write_landing(landing(spark, sf), lpath)
    start_late_dedup_stream(spark, lpath, opath, cpath).awaitTermination()
    write_landing(X.late_responses(ticks(spark, sf), sc.d_max, LATE_DAYS), lpath)
    start_late_dedup_stream(spark, lpath, opath, cpath).awaitTermination()
    kept = spark.read.parquet(opath).select("symbol", "bar_date", "close")
    landed = S.to_silver(B.flatten(read_landing(spark, lpath))).select("symbol", "bar_date", "close")
    lost = I.new_rows(landed, kept.select("symbol", "bar_date"))
    return kept.withColumn("late", F.lit(False)).unionByName(lost.withColumn("late", F.lit(True)))


def q_merged_document_flatten(spark, sf):
    """The same responses, landed as one pretty-printed document per run."""
    path = new_path(spark, "merged")
    X.write_merged(landing(spark, sf), path)
    return merged_values(spark, path).select(*BRONZE_COLUMNS, "run_date")


def q_future_dates(spark, sf):
    """Every symbol lands a day of the year 2099, and a good day one run later: the far day is rejected on every path, and
    the next run's good day is loaded all the same."""
    sc = Scenario(spark, sf)
    lpath, marks, ckpt = (new_path(spark, k) for k in ("landing", "marks", "stream-checkpoint"))
    targets = {k: new_path(spark, "target") for k in ("reload", "incremental", "stream")}
    rejected = {k: new_path(spark, "rejects") for k in targets}
    poisoned, later = X.future_responses(ticks(spark, sf), sc.d_max)
    for n, landed in ((45, landing(spark, sf).unionByName(poisoned)), (55, later)):
        write_landing(landed, lpath)
        run_incremental(spark, lpath, targets["incremental"], marks, sc.d_max + dt.timedelta(days=n), first_run_days=ALL_DAYS, rejects_path=rejected["incremental"])
        start_incremental_stream(spark, lpath, targets["stream"], ckpt, rejects_path=rejected["stream"]).awaitTermination()
    run_full_reload(spark, read_landing(spark, lpath), targets["reload"], rejected["reload"])
    mark = I.first_value(read_marks(spark, marks).agg(F.max("last_loaded_date").alias("m")), "m")
    out = []
    for k in targets:
        bad = read_rejects(spark, rejected[k]).agg(F.count_if(F.col("reason") == REJECT_FUTURE).cast("bigint").alias("n_future_date"), F.count(F.lit(1)).alias("n_rejects"))
        good = _target(spark, targets[k]).agg(F.count(F.lit(1)).alias("n_rows"), F.max("bar_date").alias("latest"), F.lit(mark).cast("date").alias("mark"))
        out.append(good.withColumn("load_path", F.lit(k)).join(bad.withColumn("load_path", F.lit(k)), "load_path"))
    return reduce(DataFrame.unionByName, out)


def q_load_paths_revised(spark, sf):
    """``load_paths_agree`` with revisions: a later copy with other values replaces the loaded one, so that all three paths end alike."""
    sc = Scenario(spark, sf)
    as_of = sc.d_max + dt.timedelta(days=50)
    lpath, marks, ckpt = (new_path(spark, k) for k in ("landing", "marks", "stream-checkpoint"))
    targets = {k: new_path(spark, "target") for k in ("reload", "incremental", "stream")}
    changed = []
    for landed in (rough_landing(spark, sf, sc.d_max), X.rough_responses(ticks(spark, sf), sc.d_max, revisions=True)):
        write_landing(landed, lpath)
        changed.append(run_incremental(spark, lpath, targets["incremental"], marks, as_of, first_run_days=ALL_DAYS, lookback_days=ALL_DAYS, revise=True)["n_changed"])
        start_incremental_stream(spark, lpath, targets["stream"], ckpt, revise=True).awaitTermination()
    run_full_reload(spark, read_landing(spark, lpath), targets["reload"])
    out = []
    for k in targets:
        good = _target(spark, targets[k])
        sums = good.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("symbol", "bar_date").alias("n_keys"), F.sum("close").cast("decimal(38,4)").alias("sum_close"), F.max("bar_date").alias("latest"))
        differing = R2.load_diff(good, _target(spark, targets["reload"])).agg(F.count(F.lit(1)).alias("n_differing"))
        out.append(sums.withColumn("load_path", F.lit(k)).join(differing.withColumn("load_path", F.lit(k)), "load_path"))
    return reduce(DataFrame.unionByName, out).withColumn("n_changed", F.lit(changed[1]).cast("bigint"))


def q_load_diff(spark, sf):
    """A reload against the stream over the rough landing with a revision: every key whose rows differ, and how."""
    sc = Scenario(spark, sf)
    lpath = new_path(spark, "landing")
    first, second = new_path(spark, "target"), new_path(spark, "target")
    write_landing(rough_landing(spark, sf, sc.d_max), lpath)
    run_full_reload(spark, read_landing(spark, lpath), first)
    write_landing(X.rough_responses(ticks(spark, sf), sc.d_max, revisions=True), lpath)
    run_full_reload(spark, read_landing(spark, lpath).filter(F.col("run_date") != F.lit(sc.d_max + dt.timedelta(days=42))), second)
    return R2.load_diff(_target(spark, first), _target(spark, second))


def q_coverage_gaps(spark, sf):
    """Days that other symbols have and a symbol lacks, in the target with a hole."""
    return V.coverage_gaps(Scenario(spark, sf).stored_target())


def q_gap_backfill(spark, sf):
    """A run that takes just the days of the gaps that are no longer than the hole: what it appends."""
    sc = Scenario(spark, sf)
    paths = sc.setup()
    target = ParquetTarget(paths["target"])
    before = target.keys(spark).checkpoint()
    gaps = V.coverage_gaps(target.read(spark)).checkpoint()
    sc.run(paths, gaps=gaps)
    return I.new_rows(_target(spark, paths["target"]), before).select("symbol", "bar_date", "close")


def q_reload_switch(spark, sf):
    """Two reloads of a catalog table: what readers see after the first, during the second, after one that fails and after the second,
    and how many of the data files of the first load still lie where they were."""
    sc = Scenario(spark, sf)
    target = CatalogTarget(f"target_{uuid.uuid4().hex[:12]}", new_path(spark, "catalog"))
    seen = []

    def look(step: str) -> None:
        files = spark.table(target.name).select(F.input_file_name().alias("f")).distinct()
        seen.append((step, spark.table(target.name).count(), files.count()))

    target.write(C.conform(sc.existing()), "overwrite")
    look("first")
    full = C.conform(G.to_gold(sc.silver))
    fresh = target._fresh()
    stored_form(full).write.partitionBy("bar_month").parquet(fresh)  # written, but not yet switched
    look("written")
    try:
        target.write(full.withColumn("volume", F.raise_error(F.lit("midway")).cast("bigint")), "overwrite")
    except Exception as e:  # noqa: BLE001
        if "midway" not in str(e):
            raise
    look("failed")
    target.switch(spark, fresh)
    look("second")
    target.clean(spark)
    left = len(target.folders(spark))
    spark.sql(f"DROP TABLE {target.name}")
    rows = [(step, n, files > 0, left) for step, n, files in seen]
    return spark.createDataFrame(rows, "step string, n_rows bigint, has_files boolean, folders_left int")


def q_new_rows_bucketed(spark, sf):
    """``new_rows`` against a table of keys in buckets: the target's side is not shuffled."""
    sc = Scenario(spark, sf)
    name = f"keys_{uuid.uuid4().hex[:12]}"
    save_bucketed(sc.existing(), name, new_path(spark, "bucketed-keys"), 16)
    return I.new_rows(sc.silver, spark.table(name))


def q_months_from_footers(spark, sf):
    """Rows and first and last day of each month of the stored target, from file footers alone."""
    return months_from_footers(spark, Scenario(spark, sf).setup(land=False)["target"])


def q_load_audit(spark, sf):
    """The audit rows of a reload, of two incremental runs over a loaded target and of the stream, each over the same landing."""
    sc = Scenario(spark, sf)
    paths = sc.setup()
    audit, reload, stream, ckpt = (new_path(spark, k) for k in ("audit", "target", "target", "stream-checkpoint"))
    run_full_reload(spark, read_landing(spark, paths["landing"]), reload, audit_path=audit, load_id="reload")
    for k in ("first", "second"):
        sc.run(paths, audit_path=audit, load_id=k)
    start_incremental_stream(spark, paths["landing"], stream, ckpt, audit_path=audit).awaitTermination()
    return read_audit(spark, audit).drop("loaded_at")


def q_stream_late_kept(spark, sf):
    """The landing of ``stream_late_rows`` with state per symbol: late days go to a table of their own."""
    sc = Scenario(spark, sf)
    lpath, opath, cpath = (new_path(spark, k) for k in ("landing", "late-rows", "stream-checkpoint"))
    write_landing(landing(spark, sf), lpath)
    start_late_rows_stream(spark, lpath, opath, cpath).awaitTermination()
    write_landing(X.late_responses(ticks(spark, sf), sc.d_max, LATE_DAYS), lpath)
    start_late_rows_stream(spark, lpath, opath, cpath).awaitTermination()
    return spark.read.parquet(opath).select("symbol", "bar_date", "close", F.col("late").cast("boolean").alias("late"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "envelope_status": q_envelope_status,
    "bronze_flatten": q_bronze_flatten,
    "rejected_rows": q_rejected_rows,
    "existing_keys": q_existing_keys,
    "table_scan": q_table_scan,
    # sinks
    "landing_roundtrip": q_landing_roundtrip,
    "full_reload": q_full_reload,
    "incremental_append": q_incremental_append,
    "conform_target": q_conform_target,
    "load_metrics": q_load_metrics,
    # projections / filters
    "silver_parse": q_silver_parse,
    "gold_bars": q_gold_bars,
    "candle_edges": q_candle_edges,
    "fixed_width_report": q_fixed_width_report,
    "labelled_report": q_labelled_report,
    "lookback_window": q_lookback_window,
    "window_counts": q_window_counts,
    # joins
    "new_rows": q_new_rows,
    "new_rows_first_run": q_new_rows_first_run,
    # aggregations
    "null_counts": q_null_counts,
    "duplicate_keys": q_duplicate_keys,
    "max_loaded_date": q_max_loaded_date,
    "row_count": q_row_count,
    "rows_per_symbol": q_rows_per_symbol,
    "latest_per_symbol": q_latest_per_symbol,
    "incremental_summary": q_incremental_summary,
    # sort / limit
    "ordered_scan": q_ordered_scan,
    "latest_bars_topk": q_latest_bars_topk,
    "preview": q_preview,
    # set operations
    "landing_merge": q_landing_merge,
    "landing_winner": q_landing_winner,
    "json_key_last_wins": q_json_key_last_wins,
    # scalar functions
    "scalar_functions": q_scalar_functions,
    # quality, incremental, composite
    "dq_report": q_dq_report,
    "dq_report_rejects": q_dq_report_rejects,
    "load_paths_agree": q_load_paths_agree,
    "per_key_recovery": q_per_key_recovery,
    "early_exits": q_early_exits,
    "fetch_window": q_fetch_window,
    "fetch_window_first_run": q_fetch_window_first_run,
    "advance_mark": q_advance_mark,
    "incremental_noop": q_incremental_noop,
    "replay_idempotent": q_replay_idempotent,
    "partial_load_recovery": q_partial_load_recovery,
    "merged_document_flatten": q_merged_document_flatten,
    "future_dates": q_future_dates,
    "load_paths_revised": q_load_paths_revised,
    "load_diff": q_load_diff,
    "coverage_gaps": q_coverage_gaps,
    "gap_backfill": q_gap_backfill,
    "reload_switch": q_reload_switch,
    "new_rows_bucketed": q_new_rows_bucketed,
    "months_from_footers": q_months_from_footers,
    "load_audit": q_load_audit,
    "stream_late_kept": q_stream_late_kept,
    # streaming re-aims
    "stream_incremental": q_stream_incremental,
    "stream_dedup_late": q_stream_dedup_late,
    "stream_late_rows": q_stream_late_rows,
}
