import math
import random
from collections import Counter

import numpy as np
import pytest
from candlelake.llm.hard_negatives import Query, encode, first, hard_negatives, kth, scores
from candlelake.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, score string"


def brute(rows, anchor, positives=5, negatives=3, least=50, most=95):
    """rows (vec_id, vector or None, label) -> rows of the result."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], n) for i, v, n in rows if i is not None and n is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, n in good:
        if not anchor(i):
            continue
        scored = sorted(((-dot(v, w), j, m) for j, w, m in good if j != i))
        for s, j, _ in [x for x in scored if x[2] == n][:positives]:
            hard = [x for x in scored if x[2] != n and least * -s <= 100 * -x[0] <= most * -s][:negatives]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hard)]
    return Counter(out)


def clustered(n, size, seed):
    rng = np.random.default_rng(seed)
    heads = rng.standard_normal((6, size))
    return [(k, (heads[k % 6] * rng.uniform(0, 1.2) + rng.standard_normal(size) * 0.6).astype(np.float32).tolist(), int(k % 6 // 2)) for k in range(n)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    return Counter(tuple(r) for r in hard_negatives(df, F.col("vec_id"), F.col("label"), F.col("embedding"), anchor=F.col("vec_id") % 10 == 0, **options).collect())


@pytest.mark.parametrize("options", [{}, {"chunk": 40, "block": 7}])
def test_against_brute_force(spark, options):
    rows = clustered(400, 24, 1)
    rows += [(1000 + k, None, 1) for k in range(3)] + [(1010, rows[0][1], None), (1020, [float("nan")] * 24, 1), (1030, [float("inf")] + [0.0] * 23, 1), (1040, [None] + [0.1] * 23, 2), (None, rows[1][1], 0)]
    # zeros, empty and short vectors, many equal vectors, integer ties
    rows += [(1050, [0.0] * 24, 0), (1060, [], 1), (1070, [0.9, -0.4], 2)] + [(2000 + k, rows[3][1], k % 3) for k in range(80)]
    got = run(spark, rows, **options)
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 300


def test_repeated_rows_one_label_and_empty(spark):
    rows = clustered(60, 8, 2)
    assert run(spark, rows[:20] * 2) == brute(rows[:20] * 2, lambda i: i % 10 == 0)
    assert run(spark, [(i, v, 1) for i, v, _ in rows]) == Counter()
    assert run(spark, [r for r in rows if r[0] % 10]) == Counter() == run(spark, [])


def test_few_rows_and_huge_components(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.9, 0.1], 0), (2, [0.7, 0.0], 1)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0) and len(run(spark, rows)) == 1
    rows = [(0, [1e7, 3.0], 0), (1, [1e7, -5.0], 0), (2, [8e6, 1.0], 1), (3, [2e4, 9.0], 1)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("size", [1, 7, 64, 130])
def test_intervals_hold_and_filter(size):
    rng = np.random.default_rng(size)
    rows = (rng.standard_normal((2000, size)) * rng.choice([0, 1, 300], (2000, 1), p=[0.01, 0.3, 0.69])).astype(np.int64)
    codes, along, across, reach = encode(rows)
    for _ in range(20):
        v = (rng.standard_normal(size) * 256).astype(np.int64)
        low, high = Query(v).interval(codes, along, across, reach)
        exact = rows @ v
        assert ((low <= exact) & (exact <= high)).all()
    if size == 64:  # half the width is well below what the norms alone would allow
        assert np.median((high - low) / (2 * np.linalg.norm(rows, axis=1).clip(1) * np.linalg.norm(v))) < 0.45


def test_popcounts_give_the_product_with_the_code():
    rng = np.random.default_rng(3)
    rows = (rng.standard_normal((50, 64)) * 256).astype(np.int64)
    codes, *_ = encode(rows)
    signs = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little") * 2.0 - 1
    from candlelake.llm.hard_negatives import rotation

    q = Query(rows[0])
    assert np.abs(q.products(codes) - signs @ (rotation(64) @ rows[0])).max() <= q.off + 1e-6


def test_helpers():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(0, 60)
        ids, score = np.array([rng.randrange(50) for _ in range(n)], np.int64), np.array([rng.randrange(8) for _ in range(n)], np.int64)
        got = first(ids, score, 3)
        assert [(-score[k], ids[k]) for k in got] == sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()))[:3]
        assert kth(score, 3) == (sorted(score.tolist())[-3] if n >= 3 else -np.inf)
    assert scores(np.array([[2**62, 2**62], [1, 1]]), np.array([2**62, 5])).tolist() == [2**63 - 1, 2**62 + 5]


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r[0], r[1], r[2] if r[2] is None or r[0] % 7 else (r[2] + 1) % 10) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = Counter(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, sf).collect())
    assert got == brute(rows, lambda i: i % 50 == 0) and got
