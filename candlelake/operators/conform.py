"""Conform gold rows to the target definition (types, key, length and domain checks)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BEARISH, BULLISH, SYMBOL_MAX_LEN
from ..schemas import TARGET


def violation() -> F.Column:
    """First rule a row breaks, or NULL. Rows are flagged, never dropped."""
    return (
        F.when(F.col("symbol").isNull() | F.col("bar_date").isNull(), F.lit("null_key"))
        .when(F.length("symbol") > SYMBOL_MAX_LEN, F.lit("symbol_too_long"))
        .when(~F.col("candle").isin(BULLISH, BEARISH), F.lit("candle_domain"))
    )


def conform(gold: DataFrame, *passthrough: str) -> DataFrame:
    """Exact target types (a value that does not fit becomes NULL) plus ``violation``."""
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TARGET.fields]
    return gold.select(*cols, *passthrough).withColumn("violation", violation())
