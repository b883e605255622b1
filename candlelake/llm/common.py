"""Helpers shared by the operators: tables, normal forms, folds and Arrow slices."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.session import new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only, whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold that decides what a model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to a fresh folder below the shared work folder and reads it back (cuts the lineage)."""
    spark = df.sparkSession
    path = new_path(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into runs of rows of about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        start, held = 0, 0
        for k, n in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if k > start and held + n > limit:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def map_slices(
    df: DataFrame, column: str, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], limit: int = SLICE_BYTES
) -> DataFrame:
    """``mapInArrow`` in slices balanced by the bytes of ``column``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit):
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)
