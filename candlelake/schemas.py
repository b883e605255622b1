"""Explicit schemas: nothing in the library infers a schema."""

from pyspark.sql import types as T

from .constants import FIELD_KEYS

PRICE = T.DecimalType(10, 4)

# One landed API response per row (JSON lines, partitioned by run_date on disk).
LANDING = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("fetched_at", T.TimestampType(), True),
        T.StructField("http_status", T.IntegerType(), True),
        T.StructField("body", T.StringType(), True),
        T.StructField("run_date", T.DateType(), True),
    ]
)

# Values of one day arrive as strings keyed "1. open" ... "5. volume".
DAY_FIELDS = T.StructType([T.StructField(k, T.StringType(), True) for k in FIELD_KEYS])

# Data values (dates) are JSON keys, so an object is read as a map from keys to values, never as an
# inferred struct: parsed values, or raw JSON text where repeated keys are to be seen.
KEYED = "map<string,variant>"
RAW_MAP = "map<string,string>"

BRONZE_COLUMNS = ("symbol", "bar_date", "open", "high", "low", "close", "volume")
GOLD_COLUMNS = BRONZE_COLUMNS + ("daily_range", "daily_return_pct", "candle")

# Target table: PRIMARY KEY (symbol, bar_date) is a check here, not a constraint.
TARGET = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("bar_date", T.DateType(), False),
        T.StructField("open", PRICE, True),
        T.StructField("high", PRICE, True),
        T.StructField("low", PRICE, True),
        T.StructField("close", PRICE, True),
        T.StructField("volume", T.LongType(), True),
        T.StructField("daily_range", PRICE, True),
        T.StructField("daily_return_pct", PRICE, True),
        T.StructField("candle", T.StringType(), True),
    ]
)

TARGET_KEYS = T.StructType(
    [T.StructField("symbol", T.StringType(), True), T.StructField("bar_date", T.DateType(), True)]
)

# High-water marks: one global row per successful load (symbol NULL), plus one row per loaded
# symbol when per-symbol marks are kept.
MARKS = T.StructType(
    [
        T.StructField("loaded_at", T.TimestampType(), True),
        T.StructField("last_loaded_date", T.DateType(), True),
        T.StructField("symbol", T.StringType(), True),
    ]
)

# Landed values that could not become rows, one per value; reject_id is a digest of all the others.
REJECTS = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("run_date", T.DateType(), True),
        T.StructField("fetched_at", T.TimestampType(), True),
        T.StructField("bar_date", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("raw", T.StringType(), True),
        T.StructField("reject_id", T.StringType(), True),
    ]
)

EMPLOYEES = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("department", T.StringType(), True),
        T.StructField("salary", T.DecimalType(10, 2), True),
        T.StructField("join_date", T.DateType(), True),
    ]
)
