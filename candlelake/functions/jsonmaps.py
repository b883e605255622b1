"""Response documents whose data values (dates) are JSON keys.

A body is parsed once, into a VARIANT; its fields, days and values are then read from the parsed form.
Repeated keys keep their last value, as in a dictionary, and text that is no JSON is NULL.

Where the repeated keys themselves are wanted, ``from_json`` into a map keeps them all (a lookup returns
the first); ``entries_by_key`` + ``last_per_key`` restore last-wins per row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    ERROR_KEY,
    INFO_KEY,
    SERIES_KEY,
    STATUS_API_ERROR,
    STATUS_HTTP_ERROR,
    STATUS_MISSING_SERIES,
    STATUS_OK,
    STATUS_RATE_LIMITED,
    STATUS_UNPARSEABLE,
)
from ..schemas import DAY_FIELDS, KEYED

REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def allow_repeated_keys(spark: SparkSession) -> None:
    """A repeated key keeps its last value when a VARIANT is parsed (by default it is an error, here NULL).
    A setting of the session, read when the plan runs."""
    spark.conf.set(REPEATED_KEYS, "true")


def parse_body(body: str | Column = "body") -> Column:
    """The parsed body; NULL if it is no JSON object (cut short, an array, other text)."""
    text = F.col(body) if isinstance(body, str) else body
    return F.when(text.rlike(r"^\s*\{"), F.try_parse_json(text))


def value_of(doc: Column, key: str, kind: str = "variant") -> Column:
    """Value of a field; NULL if it is absent or not of that kind. A JSON null is a value."""
    return F.try_variant_get(doc, f"$['{key}']", kind)


def keyed(doc: Column, key: str) -> Column:
    """A field that is an object, as a map from its keys to their values; NULL if it is none."""
    return value_of(doc, key, KEYED)


def parse_day(day: Column) -> Column:
    """One day's values as text; NULL if the day is no object."""
    return F.try_variant_get(day, "$", DAY_FIELDS.simpleString().replace("struct<", "struct<`", 1).replace(":string,", "`:string,`").replace(":string>", "`:string>"))


def envelope_status(http_status: Column, body: Column, doc: Column, series: Column) -> Column:
    """Classify a landed response, in this precedence: HTTP failure, unparseable body, rate limit
    ('Information'), API error ('Error Message'), no series, a series that is no object
    (unparseable too), ok. A key counts as present whatever its value. ``series``: keyed(doc, SERIES_KEY)."""

    def has(key: str) -> Column:
        return value_of(doc, key).isNotNull()

    return (
        F.when(body.isNull() | http_status.isNull() | (http_status >= 400), F.lit(STATUS_HTTP_ERROR))
        .when(doc.isNull(), F.lit(STATUS_UNPARSEABLE))
        .when(has(INFO_KEY), F.lit(STATUS_RATE_LIMITED))
        .when(has(ERROR_KEY), F.lit(STATUS_API_ERROR))
        .when(series.isNotNull(), F.lit(STATUS_OK))
        .when(has(SERIES_KEY), F.lit(STATUS_UNPARSEABLE))
        .otherwise(F.lit(STATUS_MISSING_SERIES))
    )


def entries_by_key(m: Column) -> Column:
    """Entries of a map column as ``struct(key, pos, value)``, ready for ``last_per_key``.

    ``pos`` is the negated position, so sorting puts a key's last entry first. The sort
    (O(n log n)) only runs when the map holds a repeated key; otherwise the entries keep their
    order and the later filter keeps them all.
    """
    indexed = F.transform(
        F.map_entries(m),
        lambda e, i: F.named_struct(F.lit("key"), e["key"], F.lit("pos"), -i, F.lit("value"), e["value"]),
    )
    distinct = F.size(F.array_distinct(F.map_keys(m))) == F.size(m)
    return F.when(distinct, indexed).otherwise(F.array_sort(indexed))


def last_per_key(entries: Column) -> Column:
    """Keep the first element of each run of equal keys (the last entry of that key).

    ``entries`` must be a column computed in an earlier projection (it is referenced inside the
    lambda).
    """
    return F.filter(
        entries,
        lambda x, i: F.when(i == 0, F.lit(True)).otherwise(entries[i - 1]["key"] != x["key"]),
    )
