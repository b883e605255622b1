"""Merged landing documents: one pretty-printed JSON file that holds the responses of all symbols.

    {
        "IBM": {
            "Meta Data": {...},
            "Time Series (Daily)": {
                "2026-05-22": {
                    "1. open": "424.7500",

Such a file has no records: to which symbol and day a line belongs depends on all lines before it. It is read
in splits all the same. Each split fills its lines forward from the symbol, section and day lines that it
holds itself, and hands on the last of each. These few rows, one per split, give each split the state in which it
starts, and only the lines before its own first symbol take theirs from there. Depth is read from the indentation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import SERIES_KEY, VOLUME_KEY
from ..functions.bars import overflows, price, volume
from ..operators.bronze import PRICES, VALUES, key_reason
from ..session import new_path

#: Spaces of one level of indentation.
INDENT = 4
#: Levels of a line's key.
SYMBOL, SECTION, DAY, FIELD = 1, 2, 3, 4
#: The fields of a day, by the name that their columns have.
FIELDS = {**PRICES, "volume": VOLUME_KEY}
#: One row per run of lines that hold a day's fields (kind FIELD: of each field its last text in the run), one per line that opens a
#: symbol or series (kind: its level) unless such a run follows that shows it, and one per split (kind 0, place: its number of lines): the
#: last symbol, section and day line of the split so far. Places are lines, counted from the split's first (-1: none yet). A
#: day that a split or an Arrow batch cuts has several runs.
LINES = "file string, run_date date, split bigint, place bigint, kind int, symbol string, symbol_at bigint, section string, section_at bigint, day string, day_at bigint, " + ", ".join(
    f"{name} string" for name in FIELDS
)
LINE = rf'^(?P<space> *)"(?P<key>(?:[^"\\]|\\.)*)" *: *(?P<value>.*?),? *$'


def _filled(text: pa.Array, places: np.ndarray, state: dict, indent: int) -> dict[str, pa.Array]:
    """Lines of one split in order -> columns of LINES but for file, run_date and split; ``state`` (name and place of the last
    line of each level) goes on from batch to batch."""
    found = pc.extract_regex(text, LINE)
    key, value = found.field("key"), found.field("value")
    deep = np.where(found.is_valid().to_numpy(zero_copy_only=False), pc.binary_length(found.field("space")).fill_null(0).to_numpy() // indent, 0)
    lines = np.arange(len(deep))
    # the run of each field line: it has the symbol, section and day of all its lines
    run = np.maximum.accumulate(np.where((deep >= SYMBOL) & (deep <= DAY), lines, -1)) + 1
    fields = np.flatnonzero(deep == FIELD)
    runs, first = np.unique(run[fields], return_index=True)
    owns = {level: np.maximum.accumulate(np.where(deep == level, lines, -1)) for level in (SYMBOL, SECTION, DAY)}
    series = pc.equal(key, SERIES_KEY).fill_null(False).to_numpy(zero_copy_only=False)
    # a run of a series that opened here after its symbol shows both lines
    by_symbol, by_section, by_day = (x[fields[first]] for x in owns.values())
    sure = (by_symbol >= 0) & (by_section > by_symbol) & (by_day > by_section) & series[by_section]
    opened = np.flatnonzero((deep == SYMBOL) | ((deep == SECTION) & series))
    opened = opened[~np.isin(opened, np.concatenate([by_symbol[sure], by_section[sure]]))]
    rows = np.concatenate([opened, fields[first]])

    out = {"place": pa.array(places[rows]), "kind": pa.array(deep[rows].astype(np.int32))}
    for level, name in ((SYMBOL, "symbol"), (SECTION, "section"), (DAY, "day")):
        own = owns[level]
        (was, was_at), at = state[level], own[rows]
        names = key.take(pa.array(at, mask=at < 0))
        out[name] = names if was is None else names.fill_null(was)
        out[f"{name}_at"] = pa.array(np.where(at >= 0, places[at], was_at))
        if own[-1] >= 0:
            state[level] = (key[int(own[-1])].as_py(), int(places[own[-1]]))
    for name, k in FIELDS.items():
        these = fields[pc.equal(key.take(pa.array(fields)), k).to_numpy(zero_copy_only=False)]
        last = np.full(len(lines) + 1, -1)
        last[run[these]] = these  # the last line of a run that has the field stays
        at = np.concatenate([np.full(len(opened), -1), last[runs]])
        out[name] = value.take(pa.array(at, mask=at < 0))
    return out


def merged_lines(spark: SparkSession, path: str, indent: int = INDENT) -> DataFrame:
    """LINES of all files below ``path`` (folders may be named ``run_date=...``), split as Spark splits text."""
    raw = spark.read.text(path)
    run = F.col("run_date").cast("date") if "run_date" in raw.columns else F.to_date(F.col("_metadata.file_modification_time"))
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), run.alias("run_date"), F.col("_metadata.file_block_start").alias("split"))
    columns = [c.split()[0] for c in LINES.split(", ")]
    kinds = [pa.int32() if c == "kind" else pa.date32() if c == "run_date" else pa.int64() if c in ("split", "place") or c.endswith("_at") else pa.string() for c in columns]

    def batch_of(own: tuple, found: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        found = found | {c: pa.repeat(pa.scalar(v, k), n) for c, v, k in zip(("file", "run_date", "split"), own, kinds)}
        return pa.RecordBatch.from_arrays([found[c].cast(k) if c in found else pa.nulls(n, k) for c, k in zip(columns, kinds)], columns)

    def run_split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, seq = None, None, 0

        def ended() -> pa.RecordBatch:
            row = {"place": seq, "kind": 0}
            for level, name in ((SYMBOL, "symbol"), (SECTION, "section"), (DAY, "day")):
                row[name], row[f"{name}_at"] = state[level]
            return batch_of(now, {c: pa.array([v], kinds[columns.index(c)]) for c, v in row.items()}, 1)

        for batch in batches:
            text, file, run_date, split = batch.columns
            changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(split[1:], split[:-1])).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for start, end in zip(cuts, cuts[1:]):
                own = (file[start].as_py(), run_date[start].as_py(), split[start].as_py())
                if own != now:  # the lines of a split come together, and in order
                    if now is not None:
                        yield ended()
                    now, seq = own, 0
                    state = {k: (None, -1) for k in (SYMBOL, SECTION, DAY)}
                found = _filled(text[start:end], seq + np.arange(end - start), state, indent)
                seq += end - start
                yield batch_of(own, found, len(found["place"]))
        if now is not None:
            yield ended()

    return raw.mapInArrow(run_split, LINES)


def merged_values(spark: SparkSession, path: str, indent: int = INDENT) -> DataFrame:
    """Landed values (as ``bronze.landed_values``, rows only) of merged documents. Of a repeated symbol, section, day or field of a file the last counts.

    The lines are stored once (in the work folder): they are read for the splits' states and for the rows.
    """
    folder = new_path(spark, "merged-lines")
    merged_lines(spark, path, indent).write.option("compression", "zstd").parquet(folder)
    lines = spark.read.schema(LINES).parquet(folder)

    # the state in which a split starts: the lines before it, and the last line of each level in them. A row per split
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    levels = ("symbol", "section", "day")
    ends = lines.filter("kind = 0").select("file", "split", *levels, *[f"{x}_at" for x in levels], F.coalesce(F.sum("place").over(before), F.lit(0)).alias("base"))
    starts = ends.select(
        F.col("file").alias("_file"), F.col("split").alias("_split"), "base", F.dense_rank().over(Window.orderBy("file")).alias("f"),
        *[F.max(F.when(F.col(f"{x}_at") >= 0, F.struct((F.col(f"{x}_at") + F.col("base")).alias("at"), x))).over(before).alias(f"in_{x}") for x in levels],
    )
    placed = lines.filter("kind > 0").join(F.broadcast(starts), (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    for x in levels:
        taken = F.col(f"{x}_at") < 0
        placed = placed.withColumn(x, F.when(taken, F.col(f"in_{x}")[x]).otherwise(F.col(x))).withColumn(f"{x}_at", F.when(taken, F.col(f"in_{x}")["at"]).otherwise(F.col(f"{x}_at") + F.col("base")))
    # a section belongs to the symbol before it, a day to the section before it
    kind, series = F.col("kind"), F.col("section") == SERIES_KEY
    placed = placed.filter((kind == SYMBOL) | (series & (F.col("section_at") > F.col("symbol_at")) & ((kind == SECTION) | (F.col("day_at") > F.col("section_at")))))
    # all that is looked up or grouped below lies within a file's symbol: one shuffle, of what is needed (f stands for the file).
    # Lines ascend, so the last series of a symbol is that of its last line, or lies before it if that has none
    placed = placed.select("f", "run_date", (F.col("place") + F.col("base")).alias("place"), "kind", "symbol", "symbol_at", F.when(kind > SYMBOL, F.col("section_at")).alias("section_at"), "day", "day_at", *FIELDS)
    own = Window.partitionBy("f", "symbol")
    for of in ("symbol", "section"):
        placed = placed.withColumn(f"last_{of}", F.max(f"{of}_at").over(own))
    fields = placed.filter((kind == FIELD) & (F.col("symbol_at") == F.col("last_symbol")) & (F.col("section_at") == F.col("last_section")))
    days = fields.groupBy("f", "run_date", "symbol", "day", "day_at").agg(*[F.max_by(name, F.when(F.col(name).isNotNull(), F.col("place"))).alias(name) for name in FIELDS])
    # of a repeated day the last
    days = days.groupBy("f", "run_date", "symbol", "day").agg(F.max(F.struct("day_at", *FIELDS)).alias("d"))
    text = {name: F.regexp_replace(F.nullif(F.col(f"d.{name}"), F.lit("null")), r'^"(.*)"$', "$1") for name in FIELDS}

    def plain(key: str) -> Column:
        quoted = F.from_json(F.concat(F.lit('["'), F.col(key), F.lit('"]')), "array<string>")[0]
        return F.when(F.contains(F.col(key), F.lit("\\")), quoted).otherwise(F.col(key))

    rows = days.select(
        plain("symbol").alias("symbol"), plain("day").alias("bar_date"), *[price(text[c]).alias(c) for c in PRICES], volume(text["volume"]).alias("volume"),
        "run_date", F.lit(None).cast("timestamp").alias("fetched_at"), sum((overflows(text[c]) for c in PRICES), F.lit(0)).alias("n_overflow"),
    )
    reason = key_reason()
    return rows.select(*VALUES, reason.alias("reason"), F.when(reason.isNotNull(), F.lit("")).alias("raw"))
