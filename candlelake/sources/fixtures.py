"""Adapters that shape the driver's tables like the reference's inputs (test plumbing).

* bars      <- orders: bar_date = o_orderdate, prices = o_totalprice ordered by o_orderkey
               (open = first, close = last), volume = orders per day; symbol = o_orderpriority
               (5 dense series) and, separately, 'C' + o_custkey (one sparse series per customer).
* landing   <- bars nested back into API response documents, one per (symbol, monthly run), the run
               labelled by its fetch day, the 15th of the month after.
               A run also re-fetches the last ``LOOKBACK_DAYS`` days of the previous month
               (replays), each document repeats its earliest day with a preliminary value first
               (a repeated JSON key, last one wins), some days carry junk values, and some runs
               were first answered with an error and then retried.
* employees <- customer.

All of it is one lazy DataFrame plan over the parquet files; no rows pass through the driver.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import (
    CLOSE_KEY,
    DATE_FORMAT,
    ERROR_KEY,
    HIGH_KEY,
    INFO_KEY,
    LOOKBACK_DAYS,
    LOW_KEY,
    META_KEY,
    META_SYMBOL_KEY,
    OPEN_KEY,
    PRICE_TYPE,
    SALARY_TYPE,
    SERIES_KEY,
    VOLUME_KEY,
)
from ..session import shuffles_removed

# Junk injected into landed days, by day of month: (day, field, text).
JUNK_DAYS = ((13, OPEN_KEY, "NaN"), (17, VOLUME_KEY, ""), (29, HIGH_KEY, "12345678.9000"))
# Runs first answered with an error, by month of the run: rate limit (with an error message too,
# to exercise precedence), API error, no series, HTTP 503.
ERROR_MONTHS = {"rate_limited": 3, "api_error": 6, "missing_series": 9, "http_error": 12}
# Day of the month on which runs fetch the month before.
FETCH_DAY = 15
RATE_LIMIT_TEXT = "Request limit reached, retry later."
API_ERROR_TEXT = "The request was not valid."
# A day that no run can hold.
FAR_DAY = "2099-01-01"
# Spaces of a level in pretty-printed documents.
INDENT = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``symbol, bar_date, seq, price``: each order as one tick of both series of ``orders_bars``. Symbols and days of the
    bars are those of the ticks, which need no shuffle."""
    return table(spark, sf_dir, "orders").select(
        F.explode(F.array("o_orderpriority", F.format_string("C%07d", "o_custkey"))).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("bar_date"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("price"),
    )


def orders_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars, unique per (symbol, bar_date), in two shapes from one orders scan:

    * few symbols with dense series: symbol = o_orderpriority (every day has orders);
    * many symbols with sparse series: symbol = 'C' + 7-digit o_custkey; their number grows
      with the table.

    Each order is one tick of both series; one hash aggregate (partial, map-side) builds all bars.
    """
    o = orders_ticks(spark, sf_dir)
    bars = o.groupBy("symbol", "bar_date").agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
    return bars.select(
        "symbol",
        "bar_date",
        *[F.col(c).cast(PRICE_TYPE).alias(c) for c in ("open", "high", "low", "close")],
        "volume",
    )


def _day_json(values: list[tuple[str, Column]]) -> Column:
    args: list[Column] = []
    for k, v in values:
        args += [F.lit(k), v]
    return F.to_json(F.create_map(*args))


def landing_from_bars(bars: DataFrame) -> DataFrame:
    """Landed responses: ``symbol, fetched_at, http_status, body, run_date``."""
    text = {c: F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")}
    dom = F.dayofmonth("bar_date")
    landed = dict(text)
    for day, key, junk in JUNK_DAYS:
        name = {OPEN_KEY: "open", HIGH_KEY: "high", VOLUME_KEY: "volume"}[key]
        landed[name] = F.when(dom == day, F.lit(junk)).otherwise(landed[name])
    fields = _day_json(
        [(OPEN_KEY, landed["open"]), (HIGH_KEY, landed["high"]), (LOW_KEY, landed["low"]),
         (CLOSE_KEY, landed["close"]), (VOLUME_KEY, landed["volume"])]
    )
    preliminary = _day_json(
        [(OPEN_KEY, text["open"]), (HIGH_KEY, text["open"]), (LOW_KEY, text["open"]),
         (CLOSE_KEY, text["open"]), (VOLUME_KEY, F.lit("0"))]
    )
    month_end = F.add_months(F.trunc("bar_date", "MM"), 1)  # first day of the next month
    run, next_run = (F.date_add(F.add_months(month_end, k), FETCH_DAY - 1) for k in (0, 1))
    runs = F.when(F.col("bar_date") >= F.date_sub(month_end, LOOKBACK_DAYS), F.array(run, next_run)).otherwise(
        F.array(run)
    )
    days = bars.select(
        "symbol",
        F.explode(runs).alias("run_date"),
        F.named_struct(
            F.lit("day"), F.date_format("bar_date", DATE_FORMAT),
            F.lit("fields"), fields,
            F.lit("preliminary"), preliminary,
        ).alias("d"),
    )
    # One document per (symbol, run): at most one month plus the lookback days.
    docs = days.groupBy("symbol", "run_date").agg(F.sort_array(F.collect_list("d"), asc=False).alias("days"))

    def entry(day: Column, obj: Column) -> Column:
        return F.concat(F.lit('"'), day, F.lit('": '), obj)

    earliest = F.element_at("days", -1)
    series = F.array_join(
        F.concat(
            F.array(entry(earliest["day"], earliest["preliminary"])),
            F.transform("days", lambda d: entry(d["day"], d["fields"])),
        ),
        ", ",
    )
    meta = F.to_json(F.create_map(F.lit(META_SYMBOL_KEY), F.col("symbol")))
    ok_body = F.concat(
        F.lit('{"' + META_KEY + '": '), meta, F.lit(', "' + SERIES_KEY + '": {'), series, F.lit("}}")
    )
    fetched = F.col("run_date").cast("timestamp") + F.expr("INTERVAL 6 HOURS")
    month = F.month("run_date")
    error_body = (
        F.when(
            month == ERROR_MONTHS["rate_limited"],
            F.to_json(F.create_map(F.lit(INFO_KEY), F.lit(RATE_LIMIT_TEXT), F.lit(ERROR_KEY), F.lit(API_ERROR_TEXT))),
        )
        .when(month == ERROR_MONTHS["api_error"], F.to_json(F.create_map(F.lit(ERROR_KEY), F.lit(API_ERROR_TEXT))))
        .when(month == ERROR_MONTHS["missing_series"], F.concat(F.lit('{"' + META_KEY + '": '), meta, F.lit("}")))
    )
    def attempt(at: Column, status: Column, body: Column) -> Column:
        # named_struct: field aliases inside struct() are lost next to a generator (Spark 4.1)
        return F.named_struct(F.lit("fetched_at"), at, F.lit("http_status"), status, F.lit("body"), body)

    ok = attempt(fetched, F.lit(200), ok_body)
    failed = attempt(
        fetched - F.expr("INTERVAL 1 HOUR"),
        F.when(month == ERROR_MONTHS["http_error"], F.lit(503)).otherwise(F.lit(200)),
        error_body,
    )
    attempts = F.when(month.isin(*ERROR_MONTHS.values()), F.array(failed, ok)).otherwise(F.array(ok))
    return docs.select("symbol", "run_date", F.explode(attempts).alias("a")).select(
        "symbol", "a.fetched_at", "a.http_status", "a.body", "run_date"
    )


def _same_day(value: str) -> str:
    """A day whose prices are all ``value``, as JSON text."""
    return json.dumps({k: value for k in (OPEN_KEY, HIGH_KEY, LOW_KEY, CLOSE_KEY)} | {VOLUME_KEY: "1"})


def _rough_body(symbol_days: list[tuple[str, str]]) -> Column:
    return F.lit('{"' + SERIES_KEY + '": {' + ", ".join(f'"{day}": {value}' for day, value in symbol_days) + "}}")


def rough_responses(bars: DataFrame, d_max: dt.date, revisions: bool) -> DataFrame:
    """Landed responses that go wrong, for every symbol, after the last day ``d_max`` of the bars:

    * a run with a date that is none, a day that is a string, a day that is a list, and one good day;
    * a run whose body is cut short;
    * a run without a fetch time, with another value for the good day and one day of its own;
    * with ``revisions`` instead: a later run that revises the good day.
    """
    day = lambda n: (d_max + dt.timedelta(days=n)).isoformat()
    if revisions:
        runs = [(43, True, _rough_body([(day(3), _same_day("3.5"))]))]
    else:
        runs = [
            (40, True, _rough_body([("2024-1-5", _same_day("1.5")), (day(1), '"oops"'), (day(2), "[1]"), (day(3), _same_day("1.5"))])),
            (41, True, F.lit('{"' + SERIES_KEY + '": {"')),
            (42, False, _rough_body([(day(3), _same_day("9.5")), (day(4), _same_day("2.5"))])),
        ]
    attempts = [
        F.named_struct(
            F.lit("run_date"), F.lit(d_max + dt.timedelta(days=n)),
            F.lit("timed"), F.lit(timed),
            F.lit("body"), body,
        )
        for n, timed, body in runs
    ]
    rows = bars.select("symbol").distinct().select("symbol", F.explode(F.array(*attempts)).alias("a"))
    fetched = F.when(F.col("a.timed"), F.col("a.run_date").cast("timestamp") + F.expr("INTERVAL 6 HOURS"))
    return rows.select("symbol", fetched.alias("fetched_at"), F.lit(200).alias("http_status"), "a.body", "a.run_date")


def late_responses(bars: DataFrame, d_max: dt.date, late_days: int) -> DataFrame:
    """One more run for every symbol, with a day ``late_days`` before ``d_max`` and one after it."""
    day = lambda n: (d_max + dt.timedelta(days=n)).isoformat()
    body = _rough_body([(day(-late_days), _same_day("7.5")), (day(2), _same_day("8.5"))])
    run = F.lit(d_max + dt.timedelta(days=60))
    rows = bars.select("symbol").distinct()
    return rows.select("symbol", run.cast("timestamp").alias("fetched_at"), F.lit(200).alias("http_status"), body.alias("body"), run.alias("run_date"))


def future_responses(bars: DataFrame, d_max: dt.date) -> tuple[DataFrame, DataFrame]:
    """Two runs for every symbol after ``d_max``: one whose days are a good one and one far in the future, and a later one with a good day."""
    day = lambda n: (d_max + dt.timedelta(days=n)).isoformat()
    runs = ((40, _rough_body([(day(3), _same_day("3.5")), (FAR_DAY, _same_day("9.5"))])), (50, _rough_body([(day(10), _same_day("4.5"))])))
    rows = bars.select("symbol").distinct()

    def run(n: int, body: Column) -> DataFrame:
        at = F.lit(d_max + dt.timedelta(days=n))
        return rows.select("symbol", at.cast("timestamp").alias("fetched_at"), F.lit(200).alias("http_status"), body.alias("body"), at.alias("run_date"))

    first, second = (run(n, body) for n, body in runs)
    return first, second


def write_merged(landing: DataFrame, path: str) -> None:
    """The ok responses of each run as one pretty-printed document, ``run_date=.../part-*.txt``, the way a
    single-process extractor leaves them (so each run is one task's work here)."""
    pad = lambda n: " " * (INDENT * n)
    ok = landing.filter(F.col("body").contains(SERIES_KEY))
    text = F.col("body")
    # line ends and indentation for the compact text that landing_from_bars makes
    for compact, pretty in (
        ('{"' + META_KEY + '": {', f'{{\n{pad(2)}"{META_KEY}": {{\n{pad(3)}'),
        ('}, "' + SERIES_KEY + '": {', f'\n{pad(2)}}},\n{pad(2)}"{SERIES_KEY}": {{\n{pad(3)}'),
        ('": {"' + OPEN_KEY, f'": {{\n{pad(4)}"{OPEN_KEY}'),
        ('"}, "', f'"\n{pad(3)}}},\n{pad(3)}"'),
        ('"}}}', f'"\n{pad(3)}}}\n{pad(2)}}}\n{pad(1)}}}'),
        *((f',"{k}":"', f',\n{pad(4)}"{k}":"') for k in (HIGH_KEY, LOW_KEY, CLOSE_KEY, VOLUME_KEY)),
        ('":"', '": "'),
    ):
        text = F.replace(text, F.lit(compact), F.lit(pretty))
    # a run's brackets go with its first and last symbol; the compact text goes through the shuffle
    run = Window.partitionBy("run_date").orderBy("symbol")
    head, tail = F.row_number().over(run) == 1, F.lead(F.lit(1)).over(run).isNull()
    rows = ok.select("run_date", "symbol", "body", head.alias("head"), tail.alias("tail"))
    rows = rows.withColumn("value", F.concat(F.lit(f'{pad(1)}"'), "symbol", F.lit('": '), text))
    line = F.coalesce(F.concat("value", F.when(F.col("tail"), "").otherwise(",")), F.lit(""))
    rows = rows.select("run_date", F.concat(F.when(F.col("head"), "{\n").otherwise(""), line, F.when(F.col("tail"), "\n}").otherwise("")).alias("value"))
    with shuffles_removed(landing.sparkSession):
        rows.write.partitionBy("run_date").text(path)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_from_bars(orders_bars(spark, sf_dir))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, name, department, salary NUMERIC(10,2), join_date``."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        F.col("c_acctbal").cast(SALARY_TYPE).alias("salary"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")).alias("join_date"),
    )
