"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import SLICE_BYTES, map_slices
from candlelake.llm.tokens import counts

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, text: str = "text", doc_id: str = "doc_id", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is the path of a .json (tokenizers) or .model (sentencepiece) file that every
    executor can open. Whole texts, in slices of about ``slice_bytes``; long texts are cut at safe
    boundaries (see tokens). NULL and empty texts have 0 tokens; NULL ids are kept; repeated rows
    are counted each; an empty table gives no rows; other columns are not read.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(1)
        n = pa.array(counts(tokenizer, texts), pa.int64())
        return pa.RecordBatch.from_arrays(
            [part.column(0), pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64()), n, pc.greater(n, limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return map_slices(rows, "text", SCHEMA, work, slice_bytes)
