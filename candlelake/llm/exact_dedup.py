"""Exact dedup: 128-bit content hash, smallest (or largest) id stays, bytes compared inside groups.

Copies are combined before anything is shuffled: the grouping key is the pair (md5, text), so a group
of any size sends one row per task, and Spark's grouping compares the texts byte by byte - two texts
with one md5 stay apart. The groups then go back to the rows by md5 and SHA-256, in a join whose hot
keys Spark splits; no group is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_dedup(docs: DataFrame, text: Column, doc_id: str = "doc_id", keep: str = "min") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``text`` is the (normalised) text as a column of ``docs``; NULL counts as empty, so all NULL and
    empty texts are copies of each other. ``keep``: "min" or "max", the id that stays. A NULL id
    stays only in a group without any other id. Rows that repeat an id and its text count in
    group_size each and share ``kept``. Texts of any length are compared whole. An empty table gives no rows; other columns are ignored.
    """
    best = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("body")).select(
        "doc_id", "body", F.unhex(F.md5(F.col("body").cast("binary"))).alias("h"), F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256")
    )
    groups = (
        rows.groupBy("h", "body", "text_sha256")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.col("h").alias("g_h"), F.col("text_sha256").alias("g_sha"), "keep_id", "group_size")
    )
    return (
        rows.select("doc_id", "h", "text_sha256")
        .join(groups, (F.col("h") == F.col("g_h")) & (F.col("text_sha256") == F.col("g_sha")))
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def keep_one(docs: DataFrame, text: Column, doc_id: str = "doc_id", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their own columns, whatever these are called.

    Of rows that repeat an id and its text one stays, whichever. NULL counts as an empty text.
    """
    stay = exact_dedup(docs, text, doc_id, keep).filter("kept").select(_key(F.col("text_sha256"), F.col("doc_id")).alias("_stay")).distinct()
    name = "_key" + "_" * max(map(len, docs.columns), default=0)  # a name that no column has
    keyed = docs.withColumn(name, _key(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), F.col(f"`{doc_id}`")))
    return keyed.join(stay, F.col(name) == F.col("_stay"), "left_semi").dropDuplicates([name]).drop(name)


def _key(sha: Column, doc_id: Column) -> Column:
    return F.concat_ws(":", sha, doc_id.cast("string"))
