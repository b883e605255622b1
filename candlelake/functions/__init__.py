"""Column expressions (JVM-side built-ins only)."""

from .bars import candle, daily_range, daily_return_pct, parse_date, price, volume
from .jsonmaps import allow_repeated_keys, entries_by_key, envelope_status, keyed, last_per_key, parse_body, parse_day, value_of
from .text import fixed_width_line, labelled_line

__all__ = [
    "allow_repeated_keys",
    "candle",
    "daily_range",
    "daily_return_pct",
    "entries_by_key",
    "keyed",
    "last_per_key",
    "envelope_status",
    "fixed_width_line",
    "labelled_line",
    "parse_body",
    "parse_day",
    "parse_date",
    "price",
    "value_of",
    "volume",
]
