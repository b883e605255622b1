import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns whose names the operators use themselves
    T.StructField("keep_id", T.StringType()),
    T.StructField("row", T.StringType()),
    T.StructField("h", T.StringType()),
])

WORDS = "stone river the of and light green table walk seven house never again small wind letter under bridge quiet morning paper answer glass".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def make(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, None, None, "x", "y", "z") for r in rows], DOCS)


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty texts, copies, near copies, shared passages, repeated rows, a long text and strange characters."""
    rng = random.Random(5)
    passage = prose(rng, 60)
    base = prose(rng, 120).split()
    near = [*base]
    near[60] = "changed"
    out = [
        (1, None), (2, ""), (3, "   \n\t "), (None, "a text without an id"), (None, None), (4, "Same Text here"), (5, "same text HERE"), (5, "same text HERE"), (6, "short"),
        (7, "ΑΒΓ Ünïcode 日本語   wide space ÀÉ"), (8, "ÀÉ àé"), (9, "tail  spaces   in \x1c odd \x0b places \n\n end "), (10, "x" * 5000), (11, "5 apples <|endoftext|> end"),
        (20, " ".join(base)), (21, " ".join(near)), (22, " ".join(base) + " more words at the end"), (23, " ".join(base).upper()),
        (30, prose(rng, 40) + " " + passage + " " + prose(rng, 30)), (31, passage + "\n" + prose(rng, 20)), (32, prose(rng, 70) + "\t" + passage), (33, passage + " " + passage),
        (40, prose(rng, 6000)),
    ]
    out += [(100 + k, prose(rng, rng.randint(1, 90))) for k in range(60)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return make(spark, rows).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make(spark, [])
