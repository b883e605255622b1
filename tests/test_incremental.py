import datetime as dt

from pyspark.sql import functions as F

from candlelake.operators.incremental import (
    advance_mark,
    fetch_window,
    in_window,
    incremental_summary,
    new_rows,
    window_counts,
)
from candlelake.plans import run_incremental
from candlelake.schemas import MARKS
from candlelake.session import new_path
from candlelake.sinks.tables import append_mark
from candlelake.sources.landing import write_landing
from candlelake.sources.tables import existing_keys, read_target
from helpers import day, doc, landing_df, rec

D = dt.date


def keys_df(spark, rows):
    return spark.createDataFrame(rows, "symbol string, bar_date date")


def days(start: D, n: int):
    return [start + dt.timedelta(days=i) for i in range(n)]


def test_anti_join_worked_example(spark):
    # 10 incoming = 2 symbols x 05-14..05-18; 6 existing = 05-14..05-16 -> 4 new.
    incoming = keys_df(spark, [(s, d) for s in ("IBM", "AAPL") for d in days(D(2026, 5, 14), 5)])
    existing = keys_df(spark, [(s, d) for s in ("IBM", "AAPL") for d in days(D(2026, 5, 14), 3)])
    got = sorted((r.symbol, r.bar_date) for r in new_rows(incoming, existing).collect())
    assert got == sorted((s, d) for s in ("IBM", "AAPL") for d in (D(2026, 5, 17), D(2026, 5, 18)))
    s = incremental_summary(incoming, existing).first()
    assert (s.n_incoming, s.n_existing, s.n_matched, s.n_new) == (10, 6, 6, 4)


def test_nothing_new(spark):
    six = keys_df(spark, [(s, d) for s in ("IBM", "AAPL") for d in days(D(2026, 5, 14), 3)])
    assert new_rows(six, six).count() == 0


def test_null_key_never_matches(spark):
    incoming = keys_df(spark, [(None, D(2026, 5, 14)), ("IBM", None), ("IBM", D(2026, 5, 14))])
    existing = keys_df(spark, [(None, D(2026, 5, 14)), ("IBM", None), ("IBM", D(2026, 5, 14))])
    assert new_rows(incoming, existing).count() == 2
    s = incremental_summary(incoming, existing).first()
    assert (s.n_matched, s.n_new) == (1, 2)


def test_anti_join_keeps_incoming_duplicates(spark):
    incoming = keys_df(spark, [("IBM", D(2026, 5, 17)), ("IBM", D(2026, 5, 17))])
    assert new_rows(incoming, keys_df(spark, [])).count() == 2


def test_window_filter_inclusive(spark):
    df = keys_df(spark, [("IBM", d) for d in days(D(2026, 5, 20), 3)])
    got = [r.bar_date for r in in_window(df, D(2026, 5, 21)).orderBy("bar_date").collect()]
    assert got == [D(2026, 5, 21), D(2026, 5, 22)]
    counts = {r.symbol: (r.n_total, r.n_in_window) for r in window_counts(df, D(2026, 5, 21)).collect()}
    assert counts == {"IBM": (3, 2)}
    assert window_counts(df, D(2026, 6, 1)).count() == 0  # no in-window record: symbol dropped


def test_lookback_and_first_run(spark):
    marks = spark.createDataFrame([(dt.datetime(2026, 5, 18, 7), D(2026, 5, 18), None)], MARKS)
    w = fetch_window(spark, marks, D(2026, 5, 22)).first()
    assert (w.last_loaded_date, w.fetch_from) == (D(2026, 5, 18), D(2026, 5, 16))
    first = fetch_window(spark, spark.createDataFrame([], MARKS), D(2026, 5, 22)).first()
    assert (first.last_loaded_date, first.fetch_from) == (None, D(2026, 2, 11))


def test_mark_never_moves_backwards(spark):
    def moved(old, batch):
        marks = spark.createDataFrame([(dt.datetime(2026, 5, 18), old, None)] if old else [], MARKS)
        return advance_mark(marks, keys_df(spark, [("IBM", batch)] if batch else [])).first().new_mark

    assert moved(D(2026, 5, 18), D(2026, 5, 15)) == D(2026, 5, 18)
    assert moved(D(2026, 5, 18), None) == D(2026, 5, 18)
    assert moved(None, D(2026, 5, 15)) == D(2026, 5, 15)
    assert moved(None, None) is None


def _landing(spark, symbols, dates, path):
    records = [
        rec(s, doc(s, {d.isoformat(): day(10 + i, 12 + i, 9 + i, 11 + i, 100 + i) for i, d in enumerate(dates)}),
            at=dt.datetime.combine(dates[-1], dt.time(6)) + dt.timedelta(days=1), run=dates[-1])
        for s in symbols
    ]
    write_landing(landing_df(spark, records), path)


def test_partial_load_recovery_and_replay(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM", "AAPL"], days(D(2026, 5, 14), 5), landing)
    # first run: nothing in the target yet, 100-day window
    r1 = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 18))
    assert (r1["outcome"], r1["new_rows"], r1["new_mark"]) == ("loaded", 10, D(2026, 5, 18))
    # replay: nothing new, mark unchanged
    r2 = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 18))
    assert (r2["outcome"], r2["new_rows"], r2["new_mark"]) == ("nothing_new", 0, D(2026, 5, 18))
    assert read_target(spark, target).count() == 10


def test_partial_load_inside_lookback_is_recovered(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM", "AAPL"], days(D(2026, 5, 14), 5), landing)
    # an earlier run loaded IBM up to 05-16 and AAPL only up to 05-15, then marked 05-16
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 18))
    t = read_target(spark, target)
    partial = t.filter(~((F.col("bar_date") > F.lit(D(2026, 5, 16))) | ((F.col("symbol") == "AAPL") & (F.col("bar_date") == F.lit(D(2026, 5, 16))))))
    target2, marks2 = new_path(spark, "target"), new_path(spark, "marks")
    from candlelake.sinks.tables import write_target

    write_target(partial.drop("bar_month"), target2, mode="overwrite")
    append_mark(spark, marks2, D(2026, 5, 16))
    r = run_incremental(spark, landing, target2, marks2, as_of=D(2026, 5, 18))
    assert r["fetch_from"] == D(2026, 5, 14)
    assert r["new_rows"] == 5  # AAPL 05-16 recovered + 05-17, 05-18 of both
    assert read_target(spark, target2).select("symbol", "bar_date").distinct().count() == 10


def test_gap_longer_than_lookback_needs_per_key(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM", "AAPL"], days(D(2026, 5, 10), 9), landing)  # 05-10 .. 05-18
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 18))
    t = read_target(spark, target)
    # AAPL failed since 05-11; IBM loaded to 05-16; the mark says 05-16
    partial = t.filter(
        ((F.col("symbol") == "IBM") & (F.col("bar_date") <= F.lit(D(2026, 5, 16))))
        | ((F.col("symbol") == "AAPL") & (F.col("bar_date") <= F.lit(D(2026, 5, 10))))
    )
    from candlelake.sinks.tables import write_target

    for per_key, expected_aapl in ((False, 6), (True, 9)):
        target2, marks2 = new_path(spark, "target"), new_path(spark, "marks")
        write_target(partial.drop("bar_month"), target2, mode="overwrite")
        append_mark(spark, marks2, D(2026, 5, 16))
        run_incremental(spark, landing, target2, marks2, as_of=D(2026, 5, 18), per_key=per_key)
        aapl = read_target(spark, target2).filter("symbol = 'AAPL'").count()
        # global mark: AAPL 05-11..05-13 fall before the window and stay missing (parity);
        # per-symbol marks recover the whole gap
        assert aapl == expected_aapl


def test_existing_keys_window_prunes_partitions(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM"], days(D(2026, 4, 28), 6), landing)
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 3))
    keys = existing_keys(spark, target, D(2026, 5, 2))
    assert sorted(r.bar_date for r in keys.collect()) == [D(2026, 5, 2), D(2026, 5, 3)]
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "bar_month" in plan and "PartitionFilters" in plan


def test_missing_target_is_first_run_but_other_errors_propagate(spark, tmp_path):
    assert existing_keys(spark, new_path(spark, "target")).count() == 0
    bad = tmp_path / "not-parquet"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("this is not parquet")
    try:
        existing_keys(spark, str(bad)).count()
    except Exception as e:  # noqa: BLE001
        assert "PATH_NOT_FOUND" not in str(e)
    else:
        raise AssertionError("a corrupt target must not look like a first run")


def test_summary_with_window_counts_old_keys_without_shuffling_them(spark):
    incoming = keys_df(spark, [(s, d) for s in ("IBM", "AAPL") for d in days(D(2026, 5, 14), 5)])
    existing = keys_df(spark, [(s, d) for s in ("IBM", "AAPL") for d in days(D(2026, 4, 1), 46)])  # to 05-16
    full = incremental_summary(incoming, existing).first()
    windowed = incremental_summary(incoming, existing, window_from=D(2026, 5, 14)).first()
    assert tuple(full) == tuple(windowed) == (10, 92, 6, 4)


def test_per_key_marks_are_recorded_and_reused(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM", "AAPL"], days(D(2026, 5, 10), 5), landing)
    r1 = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 14), per_key=True)
    assert (r1["outcome"], r1["new_rows"]) == ("loaded", 10)
    from candlelake.sources.tables import read_marks

    per_symbol = {r.symbol: r.last_loaded_date for r in read_marks(spark, marks).filter("symbol IS NOT NULL").collect()}
    assert per_symbol == {"IBM": D(2026, 5, 14), "AAPL": D(2026, 5, 14)}
    r2 = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 14), per_key=True)
    assert (r2["outcome"], r2["new_rows"]) == ("nothing_new", 0)


def test_cli_incremental_twice(spark, capsys):
    import json
    import unittest.mock as mock

    from candlelake.__main__ import main

    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM"], days(D(2026, 5, 14), 3), landing)
    args = ["incremental", "--landing", landing, "--target", target, "--marks", marks, "--as-of", "2026-05-16"]
    with mock.patch.object(type(spark), "stop", lambda self: None):
        main(args)
        main(args)
    first, second = (json.loads(line) for line in capsys.readouterr().out.strip().splitlines()[-2:])
    assert (first["outcome"], first["new_rows"], first["new_mark"]) == ("loaded", 3, "2026-05-16")
    assert (second["outcome"], second["new_rows"], second["fetch_from"]) == ("nothing_new", 0, "2026-05-14")


def test_run_folder_may_carry_any_date(spark):
    """A run dated before the first of the window's month still counts if it can hold days of the window."""
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    body = doc("IBM", {"2026-05-21": day(1, 2, 1, 2, 5), "2026-05-22": day(1, 2, 1, 2, 6)})
    write_landing(landing_df(spark, [rec("IBM", body, run=D(2026, 5, 22))]), landing)
    append_mark(spark, marks, D(2026, 5, 20))
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 23))
    assert (r["outcome"], r["new_rows"], r["new_mark"]) == ("loaded", 2, D(2026, 5, 22))


def test_bad_dates_are_counted_and_never_loaded_twice(spark):
    from candlelake.streaming import start_incremental_stream
    from candlelake.plans import run_full_reload
    from candlelake.sources.landing import read_landing

    landing, marks = new_path(spark, "landing"), new_path(spark, "marks")
    body = doc("IBM", {"2026-05-21": day(1, 2, 1, 2, 5), "2026-5-20": day(1, 2, 1, 2, 6)})
    write_landing(landing_df(spark, [rec("IBM", body, run=D(2026, 5, 22))]), landing)
    targets, rejected = ([new_path(spark, k) for _ in range(3)] for k in ("target", "rejects"))
    for _ in range(2):
        full = run_full_reload(spark, read_landing(spark, landing), targets[0], rejected[0])
        run_incremental(spark, landing, targets[1], marks, as_of=D(2026, 5, 22), rejects_path=rejected[1])
        start_incremental_stream(spark, landing, targets[2], new_path(spark, "ckpt"), rejects_path=rejected[2]).awaitTermination()
    assert full["rejects"] == {"bad_date": 1} and full["rows"] == 1
    for t, r in zip(targets, rejected):
        assert [x.bar_date for x in read_target(spark, t).collect()] == [D(2026, 5, 21)]
        assert [(x.symbol, x.bar_date, x.reason) for x in spark.read.parquet(r).collect()] == [("IBM", "2026-5-20", "bad_date")]


def test_first_loaded_stays_last_fetched_wins_a_reload(spark):
    from candlelake.streaming import start_incremental_stream
    from candlelake.plans import run_full_reload
    from candlelake.sources.landing import read_landing

    landing, marks, ckpt = (new_path(spark, k) for k in ("landing", "marks", "ckpt"))
    targets = [new_path(spark, "target") for _ in range(3)]
    for k, close in enumerate(("1.5", "2.5")):
        at = dt.datetime(2026, 5, 22 + k, 6)
        write_landing(landing_df(spark, [rec("IBM", doc("IBM", {"2026-05-21": day(1, 3, 1, close, 5)}), at=at)]), landing)
        run_incremental(spark, landing, targets[0], marks, as_of=D(2026, 5, 23))
        start_incremental_stream(spark, landing, targets[1], ckpt).awaitTermination()
    run_full_reload(spark, read_landing(spark, landing), targets[2])
    assert [float(read_target(spark, t).first().close) for t in targets] == [1.5, 1.5, 2.5]


def test_early_exits_write_nothing(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    write_landing(landing_df(spark, [rec("IBM", '{"Error Message": "x"}', run=D(2026, 5, 22))]), landing)
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 22))
    assert (r["outcome"], r["new_rows"], r["new_mark"]) == ("nothing_in_window", 0, None)
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 12, 22))
    assert r["outcome"] == "nothing_landed" and read_target(spark, target).count() == 0


def test_no_op_takes_fewer_jobs_than_a_load(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM", "AAPL"], days(D(2026, 5, 14), 5), landing)
    jobs = []
    for name in ("load", "noop"):
        spark.sparkContext.setJobGroup(name, name)
        run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 18))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] < jobs[0], jobs


def test_mark_is_made_good_after_a_run_that_died_before_it(spark):
    landing, target, marks, lost = (new_path(spark, k) for k in ("landing", "target", "marks", "marks"))
    _landing(spark, ["IBM"], days(D(2026, 5, 14), 5), landing)
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 18))
    r = run_incremental(spark, landing, target, lost, as_of=D(2026, 5, 18))  # its mark was never written
    assert (r["outcome"], r["new_mark"]) == ("nothing_new", D(2026, 5, 18))
    again = run_incremental(spark, landing, target, lost, as_of=D(2026, 5, 18))
    assert again["old_mark"] == D(2026, 5, 18)


def test_new_symbol_gets_the_first_run_window(spark):
    landing, target, marks = (new_path(spark, k) for k in ("landing", "target", "marks"))
    _landing(spark, ["IBM"], days(D(2026, 5, 1), 12), landing)
    run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 12), per_key=True)
    _landing(spark, ["NEW"], days(D(2026, 5, 1), 12), landing)
    r = run_incremental(spark, landing, target, marks, as_of=D(2026, 5, 12), per_key=True)
    assert r["new_rows"] == 12
    few = run_incremental(spark, landing, new_path(spark, "target"), new_path(spark, "marks"), as_of=D(2026, 5, 12), first_run_days=3)
    assert few["new_rows"] == 2 * 4


def test_failed_reload_leaves_the_table(spark):
    from candlelake.plans import run_full_reload
    from candlelake.sinks.tables import write_target
    from pyspark.sql import functions as F

    target = new_path(spark, "target")
    records = [rec("IBM", doc("IBM", {"2026-05-21": day(1, 2, 1, 2, 5)}))]
    run_full_reload(spark, landing_df(spark, records), target)
    bad = read_target(spark, target).withColumn("volume", F.raise_error(F.lit("midway")).cast("bigint"))
    try:
        write_target(bad.drop("bar_month"), target, mode="overwrite")
    except Exception as e:  # noqa: BLE001
        assert "midway" in str(e)
    else:
        raise AssertionError("the write must fail")
    assert read_target(spark, target).count() == 1
    empty = run_full_reload(spark, landing_df(spark, []), target)
    assert empty["rows"] == 0 and read_target(spark, target).count() == 0
