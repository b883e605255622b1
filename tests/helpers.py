"""Build landed responses from Python dicts, the way the extractor would have written them."""

from __future__ import annotations

import datetime as dt
import json

from candlelake.schemas import LANDING

#: The smallest of the given tables.
SF_SMALL = "/root/testdata/sf0.001"
SERIES = "Time Series (Daily)"


def day(o, h, l, c, v):  # noqa: E741
    return {"1. open": str(o), "2. high": str(h), "3. low": str(l), "4. close": str(c), "5. volume": str(v)}


def doc(symbol: str, days: dict) -> str:
    return json.dumps({"Meta Data": {"2. Symbol": symbol}, SERIES: days})


def landing_df(spark, records):
    """records: (symbol, fetched_at datetime, http_status, body text, run_date)."""
    return spark.createDataFrame(records, LANDING)


def rec(symbol, body, status=200, at=dt.datetime(2026, 5, 22, 6, 0), run=None):
    return (symbol, at, status, body, run or at.date())
