"""Bronze: classify landed responses and flatten them to one row per (symbol, day)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CLOSE_KEY,
    HIGH_KEY,
    LOW_KEY,
    OPEN_KEY,
    REJECT_BODY,
    REJECT_DATE,
    REJECT_DAY,
    REJECT_FUTURE,
    REJECT_SYMBOL,
    SERIES_KEY,
    STATUS_API_ERROR,
    STATUS_HTTP_ERROR,
    STATUS_MISSING_SERIES,
    STATUS_OK,
    STATUS_RATE_LIMITED,
    STATUS_UNPARSEABLE,
    VOLUME_KEY,
)
from ..functions.bars import overflows, parse_date, price, volume
from ..functions.jsonmaps import allow_repeated_keys, entries_by_key, envelope_status, keyed, parse_body, parse_day
from ..schemas import RAW_MAP


def _classified(landing: DataFrame) -> DataFrame:
    # The body is parsed once here; later projections only reference the parsed columns.
    allow_repeated_keys(landing.sparkSession)
    p = landing.select("symbol", "run_date", "fetched_at", "http_status", "body", parse_body("body").alias("doc"))
    p = p.select("*", keyed(F.col("doc"), SERIES_KEY).alias("series"))
    status = envelope_status(F.col("http_status"), F.col("body"), F.col("doc"), F.col("series"))
    return p.select("symbol", "run_date", "fetched_at", "http_status", "body", "series", status.alias("status"))


def classify(landing: DataFrame) -> DataFrame:
    """``symbol, run_date, fetched_at, http_status, status`` for every landed response."""
    return _classified(landing).select("symbol", "run_date", "fetched_at", "http_status", "status")


PRICES = {"open": OPEN_KEY, "high": HIGH_KEY, "low": LOW_KEY, "close": CLOSE_KEY}
VALUES = ("symbol", "bar_date", *PRICES, "volume", "run_date", "fetched_at", "n_overflow")
#: Reasons of values that have the form of a row all the same: bronze keeps them, the loads do not.
FORMED = (REJECT_SYMBOL, REJECT_DATE, REJECT_FUTURE)


def key_reason(day: str = "bar_date") -> Column:
    """Why the key of a landed day cannot be one: no symbol, no date, or a date after its run; NULL if it can."""
    return (
        F.when(F.col("symbol").isNull(), F.lit(REJECT_SYMBOL))
        .when(parse_date(day).isNull(), F.lit(REJECT_DATE))
        .when(parse_date(day) > F.col("run_date"), F.lit(REJECT_FUTURE))
    )


def landed_values(landing: DataFrame) -> DataFrame:
    """One row per day entry of every ok response (the last one of a repeated day), and one per unparseable
    body (without a day): ``VALUES``, ``reason`` (why it cannot be a row of the target, else NULL) and ``raw``
    (the text of such a value). Both flatten() and rejects() read this, so that a load parses once.

    A day after its run is a reject: a response cannot hold days that had not come when it was asked for,
    and one such date would move the high-water mark past all days to come.
    """
    ok = F.col("status") == F.lit(STATUS_OK)
    body = F.array(F.named_struct(F.lit("key"), F.lit(None).cast("string"), F.lit("value"), F.col("body").cast("variant")))
    found = F.when(F.col("status") == F.lit(STATUS_UNPARSEABLE), body).when(ok, F.map_entries("series"))
    d = _classified(landing).select("symbol", "run_date", "fetched_at", F.explode(found).alias("d"))
    d = d.select("symbol", "run_date", "fetched_at", F.col("d.key").alias("key"), F.col("d.value").alias("value"), parse_day(F.col("d.value")).alias("day"))
    reason = (
        F.when(F.col("key").isNull(), F.lit(REJECT_BODY))
        .when(F.col("day").isNull(), F.lit(REJECT_DAY))
        .otherwise(key_reason("key"))
    )
    d = d.select("*", reason.alias("reason"))
    text = F.when(F.col("key").isNull(), F.try_variant_get("value", "$", "string")).otherwise(F.to_json("value"))
    v = F.col("day")
    return d.select(
        "symbol",
        F.col("key").alias("bar_date"),
        *[price(v[k]).alias(name) for name, k in PRICES.items()],
        volume(v[VOLUME_KEY]).alias("volume"),
        "run_date",
        "fetched_at",
        reduce(Column.__add__, [overflows(v[k]) for k in PRICES.values()]).alias("n_overflow"),
        "reason",
        F.when(F.col("reason").isNotNull(), text).alias("raw"),
    )


def rows_of(values: DataFrame) -> DataFrame:
    """The landed values that have the form of a row, also those that no load takes."""
    return values.filter(F.col("reason").isNull() | F.col("reason").isin(*FORMED)).select(*VALUES)


def good_rows(values: DataFrame) -> DataFrame:
    """The landed values that a load takes: nothing speaks against them."""
    return values.filter(F.col("reason").isNull()).select(*VALUES)


def rejects_of(values: DataFrame) -> DataFrame:
    """The landed values that cannot become rows of the target; ``reject_id`` is a digest of each."""
    rows = values.filter(F.col("reason").isNotNull()).select("symbol", "run_date", "fetched_at", "bar_date", "reason", "raw")
    return rows.withColumn("reject_id", F.md5(F.to_json(F.struct(*rows.columns))))


def flatten(landing: DataFrame) -> DataFrame:
    """One row per (symbol, day) of every ok response, values typed.

    ``bar_date`` stays text here (parsed in silver), bad dates and dates after their run included; days that are
    no objects and unparseable bodies are not rows (see ``rejects``). Repeated days inside one body keep their
    last value; days repeated across responses (replays) are kept, with ``fetched_at`` and
    ``run_date`` as lineage for the later keep-last step. ``n_overflow`` counts prices that are
    numbers but do not fit the target's type.
    """
    return rows_of(landed_values(landing))


def rejects(landing: DataFrame) -> DataFrame:
    """Every landed value that cannot become a row of the target, with its reason and raw text:
    unparseable bodies, days that are no objects, no dates or after their run, rows without a symbol."""
    return rejects_of(landed_values(landing))


def entry_counts(landing: DataFrame) -> DataFrame:
    """Per ok response and day: how many entries the body holds for that day, the first value (what
    a plain map lookup returns) and the last value (what wins).

    Row-local and O(n log n) per body: the entries sorted by (key, position descending) form one
    run per day, whose head is the last entry and whose tail is the first. Each array is
    computed in its own projection, so lambdas reference it instead of recomputing it.
    """
    outer = F.when(F.col("status") == F.lit(STATUS_OK), F.from_json("body", RAW_MAP))
    a = _classified(landing).select("symbol", "run_date", outer.alias("outer"))
    # raw text of the days, the repeated ones too; of a repeated series the last counts
    series = F.try_element_at(F.filter(F.map_entries("outer"), lambda e: e["key"] == SERIES_KEY), F.lit(-1))["value"]
    a = a.select("symbol", "run_date", F.from_json(series, RAW_MAP).alias("series"))
    a = a.select("symbol", "run_date", entries_by_key(F.col("series")).alias("s"))
    s_ = F.col("s")
    b = a.select(
        "symbol", "run_date", "s",
        F.filter(
            F.transform("s", lambda x, i: F.named_struct(F.lit("key"), x["key"], F.lit("start"), i)),
            lambda h, i: F.when(i == 0, F.lit(True)).otherwise(s_[i - 1]["key"] != h["key"]),
        ).alias("heads"),
    )
    heads = F.col("heads")

    def run(h, j):
        end = F.when(j + 1 < F.size(heads), heads[j + 1]["start"]).otherwise(F.size(s_))
        return F.named_struct(
            F.lit("key"), h["key"],
            F.lit("n"), (end - h["start"]).cast("bigint"),
            F.lit("last"), s_[h["start"]]["value"],
            F.lit("first"), s_[end - 1]["value"],
        )

    rows = b.select("symbol", "run_date", F.explode(F.transform("heads", run)).alias("r"))
    first, last = (parse_day(F.try_parse_json(F.col(c))) for c in ("r.first", "r.last"))
    rows = rows.select("symbol", "run_date", "r", first.alias("first"), last.alias("last"))
    return rows.select(
        "symbol",
        "run_date",
        F.col("r.key").alias("bar_date"),
        F.col("r.n").alias("n_entries"),
        price(F.col("first")[CLOSE_KEY]).alias("close_first"),
        price(F.col("last")[CLOSE_KEY]).alias("close"),
        volume(F.col("last")[VOLUME_KEY]).alias("volume"),
    )


STATUSES = (STATUS_OK, STATUS_RATE_LIMITED, STATUS_API_ERROR, STATUS_MISSING_SERIES, STATUS_HTTP_ERROR, STATUS_UNPARSEABLE)


def _precedence(is_ok: Column) -> Column:
    """Order of the attempts of one run: ok ones last, then by fetch time; an unknown time comes first."""
    return is_ok.cast("long") * F.lit(10**17) + F.coalesce(F.unix_micros("fetched_at"), F.lit(-(10**16)))


def merge_attempts(landing: DataFrame) -> DataFrame:
    """Per (symbol, run): the response that counts is the last ok one, else the last failure.

    Only small fixed-width values travel through the shuffle (a status code and one long
    ordering: ok first, then fetch time), never the bodies, so the aggregate is hash-based and
    partial: a retry storm on one (symbol, run) is combined map-side.
    """
    labels = F.array(*[F.lit(s) for s in STATUSES])
    is_ok = F.col("status") == F.lit(STATUS_OK)
    order = _precedence(is_ok)
    code = F.array_position(labels, F.col("status")).cast("int")
    merged = classify(landing).groupBy("symbol", "run_date").agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if(is_ok).cast("bigint").alias("n_ok"),
        F.max_by(code, order).alias("code"),
        F.max_by("http_status", order).alias("http_status"),
    )
    return merged.select(
        "symbol", "run_date", "n_attempts", "n_ok", F.element_at(labels, F.col("code")).alias("status"), "http_status"
    )


def winning_responses(landing: DataFrame) -> DataFrame:
    """The response that counts for each (symbol, run), body included: ``symbol, run_date, fetched_at,
    http_status, status, body``.

    The winner is found on fixed-width values; the bodies only pass the join that picks it. Attempts
    with one fetch time are told apart by a digest of the body. A run without a symbol is a run too.
    """
    c = _classified(landing)
    tie = F.xxhash64("body")
    a = c.select("symbol", "run_date", "fetched_at", "http_status", "status", "body", _precedence(F.col("status") == F.lit(STATUS_OK)).alias("p"), tie.alias("t"))
    best = a.groupBy(F.col("symbol").alias("b_symbol"), F.col("run_date").alias("b_run")).agg(F.max(F.struct("p", "t")).alias("best"))
    on = F.col("symbol").eqNullSafe(F.col("b_symbol")) & F.col("run_date").eqNullSafe(F.col("b_run")) & (F.col("p") == F.col("best.p")) & (F.col("t") == F.col("best.t"))
    return a.join(best, on).select("symbol", "run_date", "fetched_at", "http_status", "status", "body").dropDuplicates(["symbol", "run_date"])
