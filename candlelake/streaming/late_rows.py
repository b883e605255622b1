"""T2 without loss: the lookback as state per symbol, with late days sent to a table of their own.

Symbols are dealt to buckets by a hash, and a bucket's rows go through one call: a call has a fixed cost, which
many symbols with a few days each would pay one by one. For the same reason a bucket's state is one value, with
the symbols of the bucket and the days of each.

A symbol's state is its newest day and the days that are still within the delay before it. A day that the state
has is a replay and is dropped; a day older than the delay allowed when its micro-batch began is
late; any other is kept, once. The state of a symbol has at most as many days as the delay, whatever its
history. Kept and late rows go to one Parquet table in folders ``late=false`` and ``late=true``, in one
transaction of the file sink, so that neither is written twice after a failure.

A late day may be one that was kept long before: which days those were is forgotten with the state, and an
anti-join against the target tells (as the incremental stream does). So kept and late days together are
all landed days, whatever the order of files and the size of micro-batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..constants import LOOKBACK_DAYS
from ..operators.bronze import good_rows, landed_values
from ..operators.silver import parse
from ..schemas import BRONZE_COLUMNS, LANDING

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets of symbols. The state of a checkpoint is keyed by them.
BUCKETS = 4096
OUT = "symbol string, bar_date date, open decimal(10,4), high decimal(10,4), low decimal(10,4), close decimal(10,4), volume bigint, late boolean"


class Lookback(StatefulProcessor):
    """Keeps, drops or sets aside the rows of one bucket of symbols."""

    def __init__(self, delay_days: int = LOOKBACK_DAYS):
        self.delay = dt.timedelta(days=delay_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        # the last of a symbol's days is its newest
        self.state = handle.getValueState("days", "symbols array<string>, recent array<array<date>>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        # of copies of a day the last fetched, as everywhere; one without a fetch time comes first
        batch = batch.sort_values("fetched_at", na_position="first", kind="stable").drop_duplicates(["symbol", "bar_date"], keep="last")
        days: dict[str, list[dt.date]] = {}
        for symbol, day in zip(batch["symbol"], batch["bar_date"]):
            days.setdefault(symbol, []).append(day)
        recent = dict(zip(*self.state.get())) if self.state.exists() else {}
        floors = {symbol: recent[symbol][-1] - self.delay for symbol in days if symbol in recent}
        seen = {symbol: set(recent.get(symbol, ())) for symbol in days}
        for symbol, own in days.items():
            held = seen[symbol].union(own)
            floor = max(held) - self.delay
            recent[symbol] = sorted(d for d in held if d >= floor)
        self.state.update((list(recent), list(recent.values())))
        late, kept = [], []
        for symbol, day in zip(batch["symbol"], batch["bar_date"]):
            late.append(symbol in floors and day < floors[symbol])
            kept.append(late[-1] or day not in seen[symbol])
        yield batch.assign(late=late).loc[kept, [*BRONZE_COLUMNS, "late"]]

    def close(self) -> None:
        pass


def start_late_rows_stream(
    spark: SparkSession, landing_path: str, out_path: str, checkpoint_path: str, delay_days: int = LOOKBACK_DAYS, max_files_per_trigger: int | None = None, fmt: str = "json"
) -> StreamingQuery:
    """The stream over a landing folder; its table has the bronze columns and ``late``.

    The state lives in RocksDB, so it may outgrow an executor's heap; the setting is the session's.
    """
    spark.conf.set(PROVIDER, ROCKS)
    src = spark.readStream.schema(LANDING)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", str(max_files_per_trigger))
    days = parse(good_rows(landed_values(src.format(fmt).load(landing_path)))).select(*BRONZE_COLUMNS, "fetched_at")
    days = days.withColumn("bucket", F.pmod(F.xxhash64("symbol"), F.lit(BUCKETS)).cast("int"))
    kept = days.groupBy("bucket").transformWithStateInPandas(Lookback(delay_days), outputStructType=OUT, outputMode="Append", timeMode="None")
    return (
        kept.writeStream.format("parquet").partitionBy("late").option("path", out_path).option("checkpointLocation", checkpoint_path)
        .outputMode("append").trigger(availableNow=True).start()
    )
