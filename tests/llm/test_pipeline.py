import zlib

import __spark_entry__
import corpus_pipeline
from candlelake.llm.exact_dedup import exact_dedup
from candlelake.llm.jaccard_join import jaccard_join
from candlelake.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F
from test_near import brute

SF = "/root/testdata/sf0.001"


def test_registered(spark):
    names = [k for k in QUERIES if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == [*range(1, 11), *range(11, 14)]
    every = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(every)
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = stage(spark, kept, SF).cache()
        assert kept.schema == docs.schema
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert after.items() <= before.items()
        if name == "quality":
            bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
            assert len(bad & set(after)) <= 1 and len(set(before) - set(after) - bad) <= len(before) * 0.2
        if name == "exact_copies":
            assert sorted(after) == sorted({t.lower(): i for i, t in sorted(before.items())}.values())
        if name == "near_copies":
            classes = brute(list(before.items()))
            assert set(after) == {i for i, (c, _, _) in classes.items() if c == i}
        if name == "benchmark_leaks":
            items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            plain = lambda t: f" {' '.join(''.join(c for c in t.lower() if c.isalnum() or c.isspace()).split())} "
            assert set(before) - set(after) == {i for i, t in before.items() if any(plain(q) in plain(t) for q in items)}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(after)
    ends = {}
    for r in packed:
        ends[r["doc_id"]] = max(ends.get(r["doc_id"], 0), r["start"] + r["length"])
    from candlelake.llm.tokens import encoder
    import public_tokenizers

    plain = encoder(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    for i, t in list(after.items())[:50]:
        ids = plain.encode(t, add_special_tokens=False).ids
        assert ends[i] == len(ids) + 1
        if len(ids) < 1024:
            raw = b"".join(x.to_bytes(4, "little") for x in [*ids, 2])
            assert next(r["ids_crc32"] for r in packed if r["doc_id"] == i) == zlib.crc32(raw)


def test_edge_rows_through_all_stages(spark, rows, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and ids: no crash, no clean document lost, nothing twice."""
    item = "A train with Anna leaves at 9 and goes 120 km in 2 hours while Anna reads 3 books how fast is it"
    texts = [(r[0], r[1]) for r in rows] + [(700, "x y " * 60_000), (700, "x y " * 60_000), (701, "see " + item), (None, "see " + item.lower()), (702, "w" * 300_000)]
    docs = spark.createDataFrame([(i, t, None, None if k % 3 else "s", len(t or "")) for k, (i, t) in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(f"{tmp_path}/full/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels = [(100 + k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (100, None, None), (99999, 1, 1)]
    for d in ("full", "none"):
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{d}/labels.parquet")
        spark.createDataFrame([(1, item), (None, "five words of another item"), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "quality":  # its labels are arbitrary here
            assert stage(spark, kept, f"{tmp_path}/full").schema == kept.schema
            continue
        before = kept.select("doc_id", "text").collect()
        kept = stage(spark, kept, f"{tmp_path}/full").cache()
        assert kept.columns == docs.columns
        after = kept.select("doc_id", "text").collect()
        if name == "exact_copies":
            assert sorted(((r["text"] or "").lower() for r in after)) == sorted({(r["text"] or "").lower() for r in before})
        if name == "benchmark_leaks":
            assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {701} and item.lower() not in {(r["text"] or "")[4:] for r in after}
    packed = corpus_pipeline.packing(spark, kept, "")
    assert packed.count() > 300 and packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    empty = spark.read.parquet(f"{tmp_path}/none/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, f"{tmp_path}/none").count() == 0


def test_groups_agree(spark):
    """Exact copies are always in one class of the similarity join."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pairs = exact_dedup(docs, F.lower("text")).select("doc_id", "keep_id").join(jaccard_join(docs), "doc_id")
    assert pairs.groupBy("keep_id").agg(F.count_distinct("class_id").alias("n")).filter("n > 1").count() == 0


def test_leaks_with_a_repeated_benchmark(spark, tmp_path, monkeypatch):
    """benchmark_leaks keeps the same rows when the items come many times; no join there holds whole texts but the one that returns them."""
    from candlelake.llm import decontam
    from test_decontam import ITEM, joins

    monkeypatch.setattr(decontam.found_items, "__defaults__", tuple(20 if x == decontam.BLOCK else x for x in decontam.found_items.__defaults__))
    texts = [(k, f"word {k} " * k + (ITEM, "nothing of the kind")[k % 2]) for k in range(8)]
    docs = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for n in (1, 12):
        spark.createDataFrame([(k, ITEM) for k in range(n)], "item_id bigint, text string").write.parquet(f"{tmp_path}/{n}/benchmark.parquet")
        kept = corpus_pipeline.benchmark_leaks(spark, docs, f"{tmp_path}/{n}")
        assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 7]
        names = [{x.output().apply(k).name() for k in range(x.output().size())} for x in joins(kept)]
        assert not any(x & {"words", "valued"} for x in names) and sum("LeftSemi" in x.toString().split("\n")[0] for x in joins(kept)) == 1
