import hashlib
import random

import numpy as np
import pytest
from candlelake.llm.substring_dedup import equal_windows, smallest_places, substring_dedup
from llm_tables import make_docs


def brute(rows, window):
    low = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                low[g] = min(low.get(g, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - window + 1):
                if low[tuple(w[k : k + window])] < i:
                    gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("group", [4096, 1])
def test_against_brute_force(docs, rows, group):
    assert got(substring_dedup(docs, window=50, group=group)) == brute(rows, 50)


@pytest.mark.parametrize(("window", "prefix", "group"), [(12, 4, 4096), (12, 4, 3), (9, 8, 4096), (50, 8, 2)])
def test_few_words_many_repeats(spark, window, prefix, group):
    rng = random.Random(window + group)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(5, 80))] for _ in range(8)]
    rows = []
    for k in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.7 else [rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))]
        rows.append((rng.randint(0, 90) if k % 7 else k, " ".join(words)))
    rows += [(500, "a " * 300), (501, "a " * 300), (499, "a " * 120)]
    assert got(substring_dedup(make_docs(spark, rows), window=window, prefix=prefix, group=group)) == brute(rows, window)


def test_kept_text(spark):
    passage = " ".join(f"p{k}" for k in range(50))
    rows = [(1, "one " + passage), (2, "two  " + passage + " three")]
    texts = {r["doc_id"]: r["kept_text"] for r in substring_dedup(make_docs(spark, rows)).collect()}
    assert texts == {1: None, 2: "two three"}


def test_empty(no_docs):
    assert substring_dedup(no_docs).count() == 0


def test_parts():
    rng = np.random.default_rng(0)
    value = rng.integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 3, 43):
        want = [k + int(np.argmin(value[k : k + width])) for k in range(300 - width + 1)]
        assert smallest_places(value, width).tolist() == want
    flat, size = rng.integers(0, 2, 400).astype(np.uint64), np.array([100, 7, 193, 100])
    where, node = equal_windows(flat, size, 13)
    assert len(where) == sum(max(0, s - 12) for s in size)
    named = {}
    for k, n in zip(where.tolist(), node.tolist()):
        assert named.setdefault(n, tuple(flat[k : k + 13])) == tuple(flat[k : k + 13])
    assert len(set(named.values())) == len(named)


@pytest.mark.parametrize("window", [3, 72, 100, 150])
@pytest.mark.parametrize("group", [4096, 1])
def test_long_and_short_windows(spark, window, group):
    rng = random.Random(window)
    shared = [f"w{rng.randrange(60)}" for _ in range(260)]
    rows = [(k, " ".join([f"o{rng.randrange(5000)}" for _ in range(30)] + shared[rng.randrange(20) :] + [f"o{rng.randrange(5000)}" for _ in range(30)])) for k in range(12)]
    frame = substring_dedup(make_docs(spark, rows), window=window, group=group)
    assert got(frame) == brute(rows, window) and frame.agg({"n_removed": "sum"}).first()[0] > 2000
