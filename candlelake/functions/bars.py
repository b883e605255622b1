"""Typed parsing of bar fields and the gold-layer derivations.

Prices are DECIMAL(10,4) end to end (the target's type), so rounding is decimal HALF_UP and exact.
Every cast that can fail on bad input is a ``try_`` form: a bad value becomes NULL and is counted
by the quality report instead of failing the job (ANSI mode is on in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BEARISH, BULLISH, DATE_FORMAT, PRICE_TYPE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price(c: str | Column) -> Column:
    """Text or number -> DECIMAL(10,4); 'NaN', junk and overflow give NULL."""
    return _col(c).try_cast(PRICE_TYPE)


def overflows(c: str | Column) -> Column:
    """1 if the text is a number that the target's price type cannot hold, else 0."""
    return (price(c).isNull() & _col(c).try_cast("decimal(38,10)").isNotNull()).cast("int")


def volume(c: str | Column) -> Column:
    return _col(c).try_cast("bigint")


def parse_date(c: str | Column) -> Column:
    """Strict 'yyyy-MM-dd'; anything else (e.g. '2024-1-5') is NULL."""
    return F.try_to_date(_col(c), DATE_FORMAT)


def daily_range(high: str | Column = "high", low: str | Column = "low") -> Column:
    """round(high - low, 2)."""
    return F.round(_col(high) - _col(low), 2).try_cast(PRICE_TYPE)


def daily_return_pct(open_: str | Column = "open", close: str | Column = "close") -> Column:
    """round((close - open) / open * 100, 2); NULL when open is 0 or NULL."""
    o, c = _col(open_), _col(close)
    return F.round(F.try_divide(c - o, o) * F.lit(100), 2).try_cast(PRICE_TYPE)


def candle(open_: str | Column = "open", close: str | Column = "close") -> Column:
    """'Bullish' if close > open, else 'Bearish' (a doji or a NULL price is Bearish)."""
    return F.when(_col(close) > _col(open_), F.lit(BULLISH)).otherwise(F.lit(BEARISH))
