"""Far dates, revisions, gaps, reconciliation, catalog and bucketed targets, footers, late rows as state."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from candlelake import queries as Q
from candlelake.operators.coverage import coverage_gaps, in_gaps
from candlelake.operators.incremental import new_rows, with_state
from candlelake.operators.reconcile import load_diff, month_checksums
from candlelake.plans import run_full_reload, run_incremental
from candlelake.session import new_path
from candlelake.sinks.catalog import CatalogTarget, save_bucketed
from candlelake.sinks.tables import read_rejects, write_target
from candlelake.sources.footers import footer_settings, months_from_footers, months_query
from candlelake.sources.landing import read_landing, write_landing
from candlelake.sources.tables import read_target
from candlelake.streaming import start_incremental_stream, start_late_rows_stream
from helpers import SF_SMALL, day, doc, landing_df, rec

D = dt.date
T0 = dt.datetime(2026, 5, 22, 6)


def land(spark, path, *bodies):
    """bodies: (symbol, {day: close}, run date)."""
    write_landing(landing_df(spark, [rec(s, doc(s, {d: day(1, 9, 1, c, 5) for d, c in days.items()}), at=dt.datetime.combine(run, dt.time(6)), run=run) for s, days, run in bodies]), path)


def closes(spark, target):
    return {(r.symbol, r.bar_date.isoformat()): float(r.close) for r in read_target(spark, target).collect()}


def bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, bar_date date")


def test_a_far_date_never_becomes_the_mark(spark):
    landing, marks, target, rejected = (new_path(spark, k) for k in ("landing", "marks", "target", "rejects"))
    land(spark, landing, ("X", {"2026-05-20": 2, "2099-01-01": 3}, D(2026, 5, 21)))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22), rejects_path=rejected)
    assert (r["outcome"], r["new_mark"], r["rejects"]) == ("loaded", D(2026, 5, 20), {"future_date": 1})
    land(spark, landing, ("X", {"2026-05-22": 4}, D(2026, 5, 23)))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 24), rejects_path=rejected)
    assert (r["outcome"], r["new_rows"], r["new_mark"], r["rejects"]) == ("loaded", 1, D(2026, 5, 22), {})
    stream, ckpt = new_path(spark, "target"), new_path(spark, "ckpt")
    start_incremental_stream(spark, landing, stream, ckpt).awaitTermination()
    reload = new_path(spark, "target")
    run_full_reload(spark, read_landing(spark, landing), reload)
    assert closes(spark, target) == closes(spark, stream) == closes(spark, reload) == {("X", "2026-05-20"): 2, ("X", "2026-05-22"): 4}


def test_rejects_are_read_by_run(spark):
    landing, marks, target, rejected = (new_path(spark, k) for k in ("landing", "marks", "target", "rejects"))
    land(spark, landing, ("X", {"2026-05-20": 2, "2026-5-1": 3}, D(2026, 5, 21)))
    for _ in range(2):
        run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22), rejects_path=rejected)
    assert [x for x in os.listdir(rejected) if x.startswith("run_date")] == ["run_date=2026-05-21"]
    assert [r.reason for r in read_rejects(spark, rejected).collect()] == ["bad_date"]


def test_a_run_counts_what_it_leaves_out(spark):
    landing, marks, target = (new_path(spark, k) for k in ("landing", "marks", "target"))
    land(spark, landing, ("X", {"2026-05-20": 2}, D(2026, 5, 21)))
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22))
    land(spark, landing, ("X", {"2026-05-01": 1, "2026-05-19": 2, "2026-05-20": 2, "2026-05-21": 3}, D(2026, 5, 22)))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22))
    assert (r["n_incoming"], r["n_matched"], r["n_new"], r["n_changed"], r["n_outside"]) == (3, 1, 2, 0, 1)


def test_revisions_touch_their_months_only(spark):
    landing, marks, target = (new_path(spark, k) for k in ("landing", "marks", "target"))
    land(spark, landing, ("X", {"2026-04-10": 1, "2026-05-20": 2, "2026-05-21": 2.5}, D(2026, 5, 22)), ("Y", {"2026-05-20": 3}, D(2026, 5, 22)))
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22), revise=True)
    april = sorted(os.listdir(f"{target}/bar_month=2026-04"))
    land(spark, landing, ("X", {"2026-05-20": 7, "2026-05-21": 2.5, "2026-05-22": 8}, D(2026, 5, 23)))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 23), revise=True)
    assert (r["outcome"], r["n_new"], r["n_changed"], r["n_matched"]) == ("loaded", 1, 1, 3)
    assert closes(spark, target) == {("X", "2026-04-10"): 1, ("X", "2026-05-20"): 7, ("X", "2026-05-21"): 2.5, ("X", "2026-05-22"): 8, ("Y", "2026-05-20"): 3}
    assert sorted(os.listdir(f"{target}/bar_month=2026-04")) == april
    assert not [x for x in os.listdir(os.path.dirname(target)) if x.startswith(os.path.basename(target) + "__")]
    again = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 23), revise=True)
    assert (again["outcome"], again["n_changed"]) == ("nothing_new", 0)


def test_state_of_incoming_rows(spark):
    schema = "symbol string, bar_date date, close int"
    held = spark.createDataFrame([("A", D(2026, 5, 1), 1), ("B", D(2026, 5, 1), None), (None, D(2026, 5, 1), 1)], schema)
    incoming = spark.createDataFrame([("A", D(2026, 5, 1), 2), ("B", D(2026, 5, 1), None), ("C", D(2026, 5, 1), 1), (None, D(2026, 5, 1), 1), ("A", D(2026, 5, 1), 1)], schema)
    got = sorted((r.symbol or "", r.close or 0, r.state) for r in with_state(incoming, held, compare=True).collect())
    assert got == [("", 1, "new"), ("A", 1, "same"), ("A", 2, "changed"), ("B", 0, "same"), ("C", 1, "new")]
    plain = with_state(incoming, held.select("symbol", "bar_date"))
    assert plain.filter("state = 'new'").drop("state").exceptAll(new_rows(incoming, held)).count() == 0
    assert plain.filter("state = 'new'").count() == new_rows(incoming, held).count()


def test_gaps_against_brute_force(spark):
    rng = random.Random(3)
    rows = sorted({(f"S{rng.randrange(9)}", D(2026, 1, 1) + dt.timedelta(days=rng.randrange(60) * 2)) for _ in range(260)})
    calendar = sorted({d for _, d in rows})
    want = []
    for s in {s for s, _ in rows}:
        own = [calendar.index(d) for x, d in rows if x == s]
        own = sorted(own) + [len(calendar)]
        want += [(s, calendar[a + 1], calendar[b - 1], b - a - 1) for a, b in zip(own, own[1:]) if b - a > 1]
    df = bars(spark, rows + [(None, D(2026, 1, 3)), ("S1", None)])
    assert sorted(tuple(r) for r in coverage_gaps(df).collect()) == sorted(want)
    assert sorted(tuple(r) for r in coverage_gaps(df, longest=2).collect()) == sorted(w for w in want if w[3] <= 2)
    every = bars(spark, [(s, d) for s in {s for s, _ in rows} for d in calendar])
    filled = in_gaps(every, coverage_gaps(df))
    assert filled.count() == sum(w[3] for w in want) == filled.distinct().count()
    assert coverage_gaps(bars(spark, [])).count() == 0


def test_a_gap_run_fills_the_gaps_and_nothing_else(spark):
    landing, marks, target = (new_path(spark, k) for k in ("landing", "marks", "target"))
    days = {f"2026-03-{k:02d}": k for k in range(1, 29)}
    land(spark, landing, ("X", days, D(2026, 3, 30)), ("Y", days, D(2026, 3, 30)))
    run_incremental(spark, landing, target, marks, as_of=D(2026, 3, 30))
    holed = read_target(spark, target).filter("not (symbol = 'Y' and day(bar_date) between 5 and 9) and not (symbol = 'X' and day(bar_date) = 2)").drop("bar_month").checkpoint()
    write_target(holed, target, mode="overwrite")
    # the window alone does not reach them
    assert run_incremental(spark, landing, target, marks, as_of=D(2026, 3, 30))["new_rows"] == 0
    gaps = coverage_gaps(read_target(spark, target), longest=5).checkpoint()
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 3, 30), gaps=gaps)
    assert (r["outcome"], r["new_rows"], r["new_mark"]) == ("loaded", 6, D(2026, 3, 28))
    assert len(closes(spark, target)) == 56 and coverage_gaps(read_target(spark, target)).count() == 0


def test_load_diff_names_every_key(spark):
    schema = "symbol string, bar_date date, close int"
    rows = [(f"S{k % 5}", D(2026, 1 + k % 6, 1 + k % 25), k) for k in range(120)]
    rows = list({r[:2]: r for r in rows}.values())
    other = [r for r in rows if r[1] != rows[3][1] or r[0] != rows[3][0]]
    other = [(s, d, 999 if (s, d) == rows[7][:2] else v) for s, d, v in other] + [("NEW", D(2027, 1, 1), 1), (None, None, 5)]
    a, b = (spark.createDataFrame(x, schema) for x in (rows, other))
    want = {(*rows[3][:2], "only_left"), (*rows[7][:2], "changed"), ("NEW", D(2027, 1, 1), "only_right"), (None, None, "only_right")}
    assert {tuple(r) for r in load_diff(a, b).collect()} == want
    # order does not matter, repeated rows do
    assert load_diff(a, a.orderBy("close", ascending=False)).count() == 0
    assert {tuple(r) for r in load_diff(a, a.unionAll(a.limit(1))).collect()} == {(*a.first()[:2], "changed")}
    assert month_checksums(a).count() == 6 and load_diff(a.limit(0), a.limit(0)).count() == 0


def gold(spark, closes_):
    from candlelake.operators.conform import conform
    from candlelake.operators.gold import to_gold

    rows = [(s, d, 1, 9, 1, c, 5) for (s, d), c in closes_.items()]
    df = spark.createDataFrame(rows, "symbol string, bar_date date, open int, high int, low int, close int, volume bigint")
    return conform(to_gold(df.select("symbol", "bar_date", *[F.col(c).cast("decimal(10,4)").alias(c) for c in ("open", "high", "low", "close")], "volume")))


def files_of(folder):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(folder.removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def test_catalog_target_switches_by_metadata(spark):
    target = CatalogTarget("swap_test", new_path(spark, "catalog"))
    target.write(gold(spark, {("X", D(2026, 5, 1)): 1}), "overwrite")
    first, old = target.location(spark), files_of(target.location(spark))
    try:
        target.write(gold(spark, {("X", D(2026, 5, 1)): 2}).withColumn("volume", F.raise_error(F.lit("midway")).cast("bigint")), "overwrite")
    except Exception as e:  # noqa: BLE001
        assert "midway" in str(e)
    else:
        raise AssertionError("the write must fail")
    assert target.location(spark) == first and [int(r.close) for r in target.read(spark).collect()] == [1]
    target.write(gold(spark, {("X", D(2026, 5, 1)): 2, ("Y", D(2026, 6, 1)): 3}), "overwrite")
    assert target.location(spark) != first and files_of(first) == old  # nothing of the old load was touched
    assert sorted(int(r.close) for r in target.read(spark).collect()) == [2, 3]
    assert target.keys(spark, D(2026, 6, 1)).collect()[0].symbol == "Y"
    target.write(gold(spark, {("Z", D(2026, 6, 2)): 4}), "append")
    target.merge(spark, gold(spark, {("Y", D(2026, 6, 1)): 5}), D(2026, 6, 1))
    assert sorted(int(r.close) for r in target.read(spark).collect()) == [2, 4, 5]
    target.clean(spark)
    assert len(target.folders(spark)) == 1 and not os.path.exists(first.removeprefix("file:"))
    assert target.read(spark).count() == 3
    spark.sql("DROP TABLE swap_test")


def test_loads_into_a_catalog_table(spark):
    landing, marks = new_path(spark, "landing"), new_path(spark, "marks")
    target = CatalogTarget("load_test", new_path(spark, "catalog"))
    land(spark, landing, ("X", {"2026-05-20": 2}, D(2026, 5, 21)))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22), revise=True)
    assert r["outcome"] == "loaded"
    land(spark, landing, ("X", {"2026-05-20": 3, "2026-05-21": 4}, D(2026, 5, 22)))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22), revise=True)
    assert (r["n_new"], r["n_changed"]) == (1, 1)
    assert run_full_reload(spark, read_landing(spark, landing), target)["rows"] == 2
    assert sorted(float(x.close) for x in target.read(spark).collect()) == [3, 4]
    spark.sql("DROP TABLE load_test")


def test_bucketed_keys_are_not_shuffled(spark):
    sc = Q.Scenario(spark, SF_SMALL)
    name = "bucketed_test"
    save_bucketed(sc.existing(), name, new_path(spark, "bucketed"), 8)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = new_rows(sc.silver.hint("shuffle_merge"), spark.table(name))
        n = df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    scan = plan.index("bucketed_test")
    join = plan.index("LeftAnti")
    assert "Exchange" not in plan[plan.rfind("+- ", 0, plan.rfind("Sort", 0, scan)) : scan], plan
    assert join < scan and re.search(r"Bucketed: true|SelectedBucketsCount", plan)
    assert n == new_rows(sc.silver, sc.existing()).count()
    spark.sql(f"DROP TABLE {name}")


def test_months_come_from_footers(spark):
    target = Q.Scenario(spark, SF_SMALL).setup(land=False)["target"]
    with footer_settings(spark):
        plan = months_query(spark, target)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(bar_date), MAX(bar_date)]" in plan and "PushedGroupBy: [bar_month]" in plan
    want = read_target(spark, target).groupBy("bar_month").agg(F.count(F.lit(1)).alias("n"), F.min("bar_date").alias("first_date"), F.max("bar_date").alias("latest_date"))
    assert sorted(map(tuple, months_from_footers(spark, target).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("files", [None, 1, 2])
def test_kept_and_late_days_are_all_landed_days(spark, files):
    landing, out, ckpt = (new_path(spark, k) for k in ("landing", "late", "ckpt"))
    rng = random.Random(7)
    landed = set()
    for k in range(6):  # runs with days far back and replays, in any order
        days = {(D(2026, 5, 1) + dt.timedelta(days=rng.randrange(25))).isoformat(): rng.randint(1, 9) for _ in range(6)}
        symbol = rng.choice("XYZ")
        landed |= {(symbol, d) for d in days}
        land(spark, landing, (symbol, days, D(2026, 6, 1) + dt.timedelta(days=k)))
        if k in (2, 5):
            start_late_rows_stream(spark, landing, out, ckpt, max_files_per_trigger=files).awaitTermination()
    rows = [(r.symbol, r.bar_date.isoformat(), str(r.late).lower()) for r in spark.read.parquet(out).collect()]
    assert {r[:2] for r in rows} == landed
    kept = [r[:2] for r in rows if r[2] == "false"]
    assert len(kept) == len(set(kept))
    if files == 1:
        assert any(r[2] == "true" for r in rows)
