"""Merged documents, read in splits: rows, order of last wins, broken lines, many splits of one file."""

import json
import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlelake import queries as Q
from candlelake.session import new_path
from candlelake.sources import fixtures as X
from candlelake.sources.merged import merged_lines, merged_values
from helpers import SERIES, SF_SMALL, day

SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture
def small_splits(spark):
    was = {k: spark.conf.get(k, None) for k in SMALL_SPLITS}
    for k, v in SMALL_SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(folder, text, name="stock_market.json"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def rows(spark, folder):
    return sorted((r.symbol, r.bar_date, r.open, r.close, r.volume) for r in merged_values(spark, str(folder)).collect())


def wanted(merged):
    def number(text, kind):
        try:
            return kind(text)
        except Exception:  # noqa: BLE001
            return None

    out = []
    for symbol, body in merged.items():
        series = body.get(SERIES) if isinstance(body, dict) else None
        for d, v in (series.items() if isinstance(series, dict) else ()):
            if isinstance(v, dict):
                out.append((symbol, d, number(v.get("1. open"), Decimal), number(v.get("4. close"), Decimal), number(v.get("5. volume"), int)))
    return sorted(out)


def test_a_document_of_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    merged = {
        f"S{k:02d}": {"Meta Data": {"2. Symbol": f"S{k:02d}"}, SERIES: {f"2026-05-{d:02d}": day(rng.randint(1, 99), 99, 1, rng.randint(1, 99), rng.randint(1, 10**6)) for d in range(1, rng.randint(2, 28))}}
        for k in range(6)
    }
    write(tmp_path, json.dumps(merged, indent=4))
    assert merged_lines(spark, str(tmp_path)).filter("kind = 0").select("split").distinct().count() > 10
    assert rows(spark, tmp_path) == wanted(merged)


def test_same_rows_as_the_landing_in_several_tasks_a_file(spark):
    path = new_path(spark, "merged")
    recent = F.col("run_date") >= "1998-05-01"
    X.write_merged(Q.landing(spark, SF_SMALL).filter(recent), path)
    columns = ["symbol", "bar_date", "open", "high", "low", "close", "volume", "run_date"]
    want = Counter(map(tuple, Q.q_bronze_flatten(spark, SF_SMALL).filter(recent).select(*columns).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = merged_lines(spark, path).filter("kind = 0")
        assert lines.groupBy("file").count().agg({"count": "max"}).first()[0] > 2
        got = Counter(map(tuple, merged_values(spark, path).select(*columns).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want and len(want) > 100


def test_files_are_json(spark):
    path = new_path(spark, "merged")
    X.write_merged(Q.landing(spark, SF_SMALL), path)
    runs = sorted(os.listdir(path))
    some = next(r for r in runs if r.startswith("run_date="))
    for name in os.listdir(f"{path}/{some}"):
        if name.endswith(".txt"):
            with open(f"{path}/{some}/{name}") as f:
                assert all(SERIES in body for body in json.load(f).values())


@pytest.mark.parametrize("split", ["700", "128m"])
def test_last_wins(spark, tmp_path, split, small_splits):
    """A repeated symbol, section, day or field: the last one counts, as in a dictionary."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    one = {"Meta Data": {}, SERIES: {"2026-05-01": day(1, 1, 1, 1, 1), "2026-05-02": day(2, 2, 2, 2, 2)}}
    two = {SERIES: {"2026-05-03": day(3, 3, 3, 3, 3), "2026-05-04": {}}}
    text = json.dumps({"A": one, "B": one, "A ": two, "C": {"first": one[SERIES], SERIES + " ": one[SERIES], SERIES: two[SERIES]}}, indent=4)
    text = text.replace('"A "', '"A"').replace(f'"{SERIES} "', f'"{SERIES}"').replace('"2026-05-04": {}', '"2026-05-03": {\n                "1. open": "8",\n                "1. open": "9"\n            }')
    write(tmp_path, text)
    assert rows(spark, tmp_path) == wanted(json.loads(text))  # a dictionary keeps the last too


def test_odd_lines(spark, tmp_path):
    """Failed responses, days that are no objects, NULL, numbers, escapes, an empty document and one without lines."""
    merged = {
        "I": {"Information": "limit"}, "E": {"Error Message": "bad: {"}, "N": {SERIES: {}}, "X": {SERIES: "none"}, 'q"uote': {SERIES: {"2026-05-01": day(1, 1, 1, 1, 1)}},
        "V": {SERIES: {"2026-05-01": "oops", "2026-05-02": {"1. open": None, "4. close": 2.5, "5. volume": "x"}, "no date": day(1, "NaN", 1, 1, 1)}},
    }
    write(tmp_path, json.dumps(merged, indent=4))
    write(tmp_path, "{}", "empty.json")
    write(tmp_path, "", "nothing.json")
    assert rows(spark, tmp_path) == wanted(merged)


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_random_documents(spark, tmp_path, batch, small_splits):
    """Keys of all levels repeat and come in any order, in splits and Arrow batches of a few lines."""
    rng = random.Random(4)
    pairs = lambda n, key, value: "{" + ", ".join(f"{json.dumps(key())}: {value()}" for _ in range(n)) + "}"
    fields = ["1. open", "4. close", "5. volume", "other"]
    own = lambda: pairs(rng.randint(1, 6), lambda: rng.choice(fields), lambda: rng.choice(['"1"', '"2"', "3", "null"]))
    days = lambda: pairs(rng.randint(0, 4), lambda: f"2026-05-0{rng.randint(1, 4)}", own)
    sections = lambda: pairs(rng.randint(0, 3), lambda: rng.choice([SERIES, SERIES, "Meta Data"]), lambda: rng.choice([days, days, lambda: '"none"'])())
    want = []
    for k in range(9):
        text = pairs(rng.randint(1, 7), lambda: rng.choice("ABCD"), sections)
        want += wanted(json.loads(text))

        class Pairs(list):
            pass

        def shown(x, pad):
            if not isinstance(x, Pairs):
                return json.dumps(x)
            inner = " " * (pad + 4)
            return "{\n" + ",\n".join(f"{inner}{json.dumps(key)}: {shown(v, pad + 4)}" for key, v in x) + "\n" + " " * pad + "}" if x else "{}"

        write(tmp_path, shown(json.loads(text, object_pairs_hook=Pairs), 0), f"{k}.json")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = Counter((r.symbol, r.bar_date, r.open, r.close, r.volume) for r in merged_values(spark, str(tmp_path)).collect())
        assert got == Counter(want) and len(want) > 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_lines_are_few_and_shuffled_once(spark, tmp_path):
    """What is stored and shuffled grows with the days: no row of its own for a symbol or section that a day shows, no shuffle by split."""
    merged = {f"S{k}": {"Meta Data": {"2. Symbol": f"S{k}"}, SERIES: {"2026-05-01": day(1, 1, 1, 1, 1), "2026-05-02": day(2, 2, 2, 2, 2)}} for k in range(5)} | {"N": {SERIES: {}}}
    write(tmp_path, json.dumps(merged, indent=4))
    kinds = Counter(r.kind for r in merged_lines(spark, str(tmp_path)).collect())
    assert kinds == {0: 1, 1: 1, 2: 1, 4: 10}  # only N has lines that no day shows
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = merged_values(spark, str(tmp_path))
        assert "SortMergeJoin" not in values._jdf.queryExecution().executedPlan().toString()
        assert values.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_no_shuffle_files_of_the_write_stay(spark):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for k in range(blocks.size()) if (name := blocks.apply(k).name()).startswith("shuffle_")}

    was = shuffled()
    X.write_merged(Q.landing(spark, SF_SMALL), new_path(spark, "merged"))
    assert shuffled() <= was


def test_a_reload_from_merged_documents(spark, tmp_path, capsys):
    import unittest.mock as mock

    from candlelake.__main__ import main
    from candlelake.sources.tables import read_target

    merged = {"A": {SERIES: {"2026-05-01": day(1, 2, 1, 2, 5), "2026-5-2": day(1, 1, 1, 1, 1), "2099-01-01": day(9, 9, 9, 9, 9)}}, "B": {SERIES: {"2026-05-01": day(3, 4, 3, 4, 6)}}}
    write(tmp_path / "landing" / "run_date=2026-05-02", json.dumps(merged, indent=4))
    target = new_path(spark, "target")
    with mock.patch.object(type(spark), "stop", lambda self: None):
        main(["full-reload", "--merged", "--landing", str(tmp_path / "landing"), "--target", target, "--rejects", new_path(spark, "rejects")])
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert result["rows"] == 2 and result["rejects"] == {"bad_date": 1, "future_date": 1}
    assert sorted((r.symbol, float(r.close)) for r in read_target(spark, target).collect()) == [("A", 2.0), ("B", 4.0)]


def test_a_day_is_one_row_and_symbols_are_shuffled_once(spark, tmp_path):
    """The fields of a day stay together, and what is looked up per symbol and day needs no shuffle of its own."""
    merged = {s: {SERIES: {f"2026-05-{d:02d}": day(d, 9, 1, 2, 3) | {"6. more": "x"} for d in range(1, 11)}} for s in "ABC"}
    merged["D"] = {"Meta Data": {"x": {"1. open": "5"}}, SERIES: {"2026-05-01": {"6. more": "x"}, "2026-05-02": {}}}
    write(tmp_path, json.dumps(merged, indent=4))
    assert merged_lines(spark, str(tmp_path)).filter("kind = 4").count() == 3 * 10 + 2  # the sections' own fields are one run more
    df = merged_values(spark, str(tmp_path))
    got = sorted((r.symbol, r.bar_date, r.open, r.close, r.volume) for r in df.collect())
    assert got == sorted([(s, f"2026-05-{d:02d}", Decimal(d), Decimal(2), 3) for s in "ABC" for d in range(1, 11)] + [("D", "2026-05-01", None, None, None)])
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len({x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "symbol" in x}) == 1, plan
