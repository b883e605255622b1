"""Incremental load: fetch window, lookback filter, anti-join against the target, summaries and
the high-water mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FIRST_RUN_DAYS, KEY, LOOKBACK_DAYS


def fetch_window(
    spark: SparkSession,
    marks: DataFrame,
    as_of: dt.date,
    lookback_days: int = LOOKBACK_DAYS,
    first_run_days: int = FIRST_RUN_DAYS,
) -> DataFrame:
    """One row: ``last_loaded_date, as_of, fetch_from``.

    fetch_from = last mark - lookback days (calendar days); without a mark (first run)
    as_of - first_run_days.
    """
    mark = marks.agg(F.max("last_loaded_date").alias("last_loaded_date"))
    return mark.select(
        "last_loaded_date",
        F.lit(as_of).alias("as_of"),
        F.coalesce(
            F.date_sub("last_loaded_date", lookback_days), F.date_sub(F.lit(as_of), first_run_days)
        ).alias("fetch_from"),
    )


def per_symbol_marks(target: DataFrame) -> DataFrame:
    """Mark per symbol (``latest_per_symbol``), for a window that no longer loses a gap of one
    symbol that failed for longer than the lookback."""
    return target.groupBy("symbol").agg(F.max("bar_date").alias("last_loaded_date"))


def first_value(df: DataFrame, column: str):
    """A one-row scalar to the driver (a mark or a date, never data)."""
    row = df.select(column).first()
    return None if row is None else row[0]


def in_window(df: DataFrame, fetch_from: dt.date, column: str = "bar_date") -> DataFrame:
    """Keep ``bar_date >= fetch_from`` (inclusive); pushed to the scan when it can be. Rows without a
    date are in no window; the loaders account for them as rejects before they come here."""
    return df.filter(F.col(column) >= F.lit(fetch_from))


def in_window_per_symbol(df: DataFrame, symbol_marks: DataFrame, floor: dt.date, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Per-symbol window: ``bar_date >= mark(symbol) - lookback``, never before ``floor`` (the
    first-run window). A symbol without a mark gets the whole first-run window; one that was silent
    for longer is treated like a new one, so a dead symbol never widens the scan. The mark table has
    one row per symbol; Spark broadcasts it when its size estimate is under the broadcast threshold
    and shuffles otherwise."""
    m = symbol_marks.select("symbol", F.date_sub("last_loaded_date", lookback_days).alias("_from"))
    j = df.join(m, "symbol", "left")
    return j.filter(F.col("bar_date") >= F.greatest(F.coalesce("_from", F.lit(floor)), F.lit(floor))).drop("_from")


def window_counts(silver: DataFrame, fetch_from: dt.date) -> DataFrame:
    """Per symbol: all days vs days in the window; symbols with nothing in the window drop out."""
    return (
        silver.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("n_total"),
            F.count_if(F.col("bar_date") >= F.lit(fetch_from)).cast("bigint").alias("n_in_window"),
        )
        .filter(F.col("n_in_window") > 0)
    )


def new_rows(incoming: DataFrame, existing_keys: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Left anti equi-join on the composite key: incoming rows the target does not hold.

    A NULL key part never matches, so such rows are kept. The incoming side is not
    deduplicated here. Spark chooses broadcast or shuffled join from the sides' sizes (AQE
    re-plans at runtime and splits skewed partitions).
    """
    return incoming.join(existing_keys.select(*keys), list(keys), "left_anti")


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row's values; NULLs count by their place."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns])


def with_state(incoming: DataFrame, existing: DataFrame, compare: bool = False, keys: tuple[str, ...] = KEY) -> DataFrame:
    """``incoming`` with ``state``: ``new`` (no such key in ``existing``), ``same``, or with ``compare`` also ``changed``
    (other values than the existing row has).

    The anti-join of ``new_rows`` and the counts of a run in one pass: a left join that keeps both kinds. The keys of
    ``existing`` are unique or have equal rows; a NULL key part never matches, so such rows are new.
    """
    columns = [c for c in existing.columns if c not in keys] if compare else []
    held = existing.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(row_hash(columns) if compare else F.lit(0)).alias("_held"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    state = F.when(F.col("_held").isNull(), F.lit("new"))
    if compare:
        state = state.when(F.col("_held") != row_hash(columns), F.lit("changed"))
    return incoming.join(held, on, "left").select(*incoming.columns, state.otherwise(F.lit("same")).alias("state"))


def incremental_summary(
    incoming: DataFrame,
    existing_keys: DataFrame,
    keys: tuple[str, ...] = KEY,
    window_from: dt.date | None = None,
) -> DataFrame:
    """One row: ``n_incoming, n_existing`` (whole target), ``n_matched, n_new``.

    Both sides are tagged and unioned, grouped by key (partial counts map-side), then summed.
    With ``window_from`` (all incoming rows are on or after it), target keys older than the
    window are only counted, not shuffled: the key shuffle stays window-sized however long the
    history is. The two one-row results are combined by union and sum.
    """
    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    ex = existing_keys.select(*keys)
    older = None
    if window_from is not None:
        recent_cond = F.col("bar_date").isNull() | (F.col("bar_date") >= F.lit(window_from))
        older = ex.filter(~recent_cond).agg(
            F.lit(0).cast("bigint").alias("n_incoming"),
            F.count(F.lit(1)).alias("n_existing"),
            F.lit(0).cast("bigint").alias("n_matched"),
            F.lit(0).cast("bigint").alias("n_new"),
        )
        ex = ex.filter(recent_cond)
    inc = incoming.select(*keys, F.lit(1).alias("i"), F.lit(0).alias("e"))
    tagged = ex.select(*keys, F.lit(0).alias("i"), F.lit(1).alias("e"))
    per_key = inc.unionByName(tagged).groupBy(*keys).agg(
        F.sum("i").alias("i"), F.sum("e").alias("e"), F.first(valid).alias("valid")
    )
    matched = F.col("valid") & (F.col("e") > 0)
    summary = per_key.agg(
        F.coalesce(F.sum("i"), F.lit(0)).cast("bigint").alias("n_incoming"),
        F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("n_existing"),
        F.coalesce(F.sum(F.when(matched, F.col("i")).otherwise(0)), F.lit(0)).cast("bigint").alias("n_matched"),
        F.coalesce(F.sum(F.when(~matched, F.col("i")).otherwise(0)), F.lit(0)).cast("bigint").alias("n_new"),
    )
    if older is None:
        return summary
    cols = ("n_incoming", "n_existing", "n_matched", "n_new")
    return summary.unionByName(older).agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])


def max_loaded_date(df: DataFrame) -> DataFrame:
    """One row: the batch's max ``bar_date`` (NULL for an empty batch)."""
    return df.agg(F.max("bar_date").alias("max_loaded_date"))


def advance_mark(marks: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: ``old_mark, batch_max, new_mark = greatest(old, batch)``, from the marks table and a
    loaded batch - late rows never move the mark backwards, an empty batch leaves it unchanged."""
    none = F.lit(None).cast("date")
    old = marks.agg(F.max("last_loaded_date").alias("old_mark")).select("old_mark", none.alias("batch_max"))
    new = max_loaded_date(batch).select(none.alias("old_mark"), F.col("max_loaded_date").alias("batch_max"))
    both = old.unionByName(new).agg(F.max("old_mark").alias("old_mark"), F.max("batch_max").alias("batch_max"))
    return both.select("old_mark", "batch_max", F.greatest("old_mark", "batch_max").alias("new_mark"))
