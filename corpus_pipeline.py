"""Corpus pipeline: from the table of documents to packed training sequences.

Rejected by the quality classifier, repeated exactly, similar to another document or holding a
benchmark item: such documents go, stage by stage; what is left is packed. Every stage but the last
returns rows of documents with all their columns, so stages can be stored, repeated or left out.

Edge rows: columns other than doc_id and text may be NULL and are passed on. A NULL text is an empty one; all empty
texts are copies of each other, are similar to nothing and hold no item. Rows without an id are judged by their own
text; near_copies keeps them all. Of rows that repeat an id and its text one stays; of equal texts the largest
id, of similar ones the smallest. Texts of any length are read whole and packed in pieces. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm.common import fold, lower_ascii, stored, table
from candlelake.llm.decontam import without_leaks
from candlelake.llm.exact_dedup import keep_one
from candlelake.llm.jaccard_join import one_of_each
from candlelake.llm.packing import best_fit_packing
from candlelake.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (learnt from the labels of its learning folds) does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"), learn=fold(F.col("doc_id"), 3) != 1)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each group of equal texts (A-Z in lower case)."""
    return keep_one(docs, lower_ascii(F.col("text")), keep="max")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of similar texts (five words, 0.8)."""
    return one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packing),
]

#: The classifier and the tokenizer have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
