import hashlib
import string

from candlelake.llm.common import lower_ascii
from candlelake.llm.exact_dedup import exact_dedup, keep_one
from pyspark.sql import functions as F

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_against_brute_force(docs, rows):
    for keep, best in (("max", max), ("min", min)):
        groups = {}
        for i, t in rows:
            groups.setdefault((t or "").translate(LOWER), []).append(i)
        want = []
        for i, t in rows:
            body = (t or "").translate(LOWER)
            ids = [x for x in groups[body] if x is not None]
            top = best(ids) if ids else None
            want.append((i, top, len(groups[body]), i == top, hashlib.sha256(body.encode()).hexdigest()))
        got = [tuple(r) for r in exact_dedup(docs, lower_ascii(F.col("text")), keep=keep).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_only_a_to_z_are_folded(docs):
    got = {r["doc_id"]: r for r in exact_dedup(docs, lower_ascii(F.col("text")), keep="max").collect()}
    assert got[8]["group_size"] == 1 and got[4]["keep_id"] == 5


def test_keep_one_has_all_columns(docs):
    kept = keep_one(docs, lower_ascii(F.col("text")), keep="max")
    assert kept.schema == docs.schema
    texts = [r["text"] for r in kept.filter("doc_id < 10").collect()]
    assert texts.count("same text HERE") == 1  # of rows that repeat id and text one stays
    assert "Same Text here" not in texts


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a", "p"), (1, "a", "q"), (1, "A", "r"), (2, "b", "s"), (None, "c", "t"), (None, "C", "u"), (None, None, "v"), (3, "", "w"), (1, "b", "x")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, _key string"), lower_ascii(F.col("text")), keep="max").collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in kept) == [(0, "c"), (1, "a"), (2, "b"), (3, "")]
    assert all(tuple(r) in rows for r in kept)


def test_empty(no_docs):
    assert exact_dedup(no_docs, F.col("text")).count() == 0
    assert keep_one(no_docs, F.col("text")).count() == 0


def test_native(docs):
    plan = exact_dedup(docs, F.col("text"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
