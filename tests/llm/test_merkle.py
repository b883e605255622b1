import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from candlelake.llm.common import fold, lower_ascii
from candlelake.llm.merkle import build, numbered, proofs, record_digest
from candlelake.llm.queries import QUERIES
from pyspark.sql import functions as F


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


AA = H("a")


def record(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves, fan):
    """(root, for each leaf its runs of siblings as (before, after, whether a run is hashed))."""
    paths, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[k : k + fan] for k in range(0, len(level), fan)]
        for i, at in enumerate(where):
            run, p = runs[at // fan], at % fan
            paths[i].append(("".join(run[:p]), "".join(run[p + 1 :])))
        level, where = [H(*r) for r in runs], [at // fan for at in where]
    return (level[0] if level else None), paths


def brute(rows, fan):
    """rows (doc_id, source, leaf, presented) -> rows (doc_id, leaf, subroot, root, siblings, folded_root)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        made[s] = tree([r[2] for r in groups[s]], fan)
    root, tops = tree([made[s][0] for s in names], fan)
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(groups[s], made[s][1]):
            folded = r[3]
            for before, after in path + top:
                folded = H(before, folded, after)
            out.append((r[0], r[2], made[s][0], root, "".join(a + b for a, b in path + top), folded))
    return out


def tampered(doc_id, text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if text and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else text


@pytest.mark.parametrize("fan", [16, 3])
def test_against_brute_force(spark, rows, fan):
    sources = ["b", None, "B", "ä", "a", "b", "b"]
    given = [(r[0], r[1].capitalize() if r[1] and k % 2 else r[1], r[2] if len(r) > 2 else None, sources[k % 7] if k > 2 else "lone%d" % k, k % 9 or None) for k, r in enumerate(rows)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in given], "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, tree string").repartition(4)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = record_digest(*fields, F.col("text"))
    bad = F.when(fold(F.col("doc_id"), 5) == 0, record_digest(*fields, lower_ascii(F.col("text")))).otherwise(leaf)
    got = proofs(build(docs, F.col("doc_id"), F.col("source"), leaf, presented=bad, fan=fan)).collect()
    want = brute([(i, s, record(i, s, lang, n, t), record(i, s, lang, n, tampered(i, t))) for i, t, lang, s, n in given], fan)
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert 0 < sum(r["folded_root"] != r["root"] for r in got) < len(got)


def test_one_leaf_one_group_and_empty(spark, no_docs):
    def run(df):
        return proofs(build(df, F.col("doc_id"), F.col("source"), F.col("leaf"), fan=2)).collect()

    one = spark.createDataFrame([(1, "s", AA)], "doc_id bigint, source string, leaf string")
    assert [tuple(r) for r in run(one)] == [(1, AA, AA, AA, "", AA)]
    # repeated rows in one group: leaves of their own
    same = spark.createDataFrame([(1, None, AA)] * 3, "doc_id bigint, source string, leaf string")
    assert Counter(tuple(r) for r in run(same)) == Counter(brute([(1, None, AA, AA)] * 3, 2))
    assert run(one.limit(0)) == []
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"
    assert proofs(build(no_docs, F.col("doc_id"), F.col("source"), F.col("text"))).count() == 0


def test_seats_follow_the_order(spark):
    rows = [(k * 7919 % 1000,) for k in range(1000)] + [(None,), (5,), (5,)]
    got = numbered(spark.createDataFrame(rows, "x bigint").repartition(9), "x").collect()
    assert sorted(r["seat"] for r in got) == list(range(len(rows)))
    assert [r["x"] for r in sorted(got, key=lambda r: r["seat"])] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    want = brute([(r[0], r[1], record(*r), record(*r[:4], tampered(r[0], r[4]))) for r in docs], 16)
    got = QUERIES["op13_merkle_manifest"](spark, sf).collect()
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in got) == Counter((*w[:4], H(w[4]), w[5]) for w in want)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
