"""Gold: range, return and candle, in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PRICE_TYPE
from ..functions.bars import candle, daily_range, daily_return_pct
from ..schemas import BRONZE_COLUMNS


def to_gold(silver: DataFrame, *passthrough: str) -> DataFrame:
    return silver.select(
        *BRONZE_COLUMNS,
        *passthrough,
        daily_range("high", "low").alias("daily_range"),
        daily_return_pct("open", "close").alias("daily_return_pct"),
        candle("open", "close").alias("candle"),
    )


def candle_edges(silver: DataFrame) -> DataFrame:
    """Gold derivations over each bar and its edge variants: as landed, NULL open, doji
    (open = close), zero open (row-local, no shuffle)."""
    o = F.col("open")
    def variant(name: str, value: F.Column) -> F.Column:
        return F.named_struct(F.lit("variant"), F.lit(name), F.lit("open"), value)

    opens = F.array(
        variant("as_landed", o),
        variant("null_open", F.lit(None).cast(PRICE_TYPE)),
        variant("doji", F.col("close")),
        variant("zero_open", F.lit(0).cast(PRICE_TYPE)),
    )
    v = silver.select("symbol", "bar_date", "close", F.explode(opens).alias("v"))
    return v.select(
        "symbol",
        "bar_date",
        F.col("v.variant").alias("variant"),
        F.col("v.open").alias("open"),
        "close",
        daily_return_pct("v.open", "close").alias("daily_return_pct"),
        candle("v.open", "close").alias("candle"),
    )
