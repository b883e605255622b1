import datetime as dt

from candlelake.session import new_path
from candlelake.sources.landing import write_landing
from candlelake.sources.tables import read_target
from candlelake.streaming import start_incremental_stream, start_late_dedup_stream
from helpers import SF_SMALL, day, doc, landing_df, rec

D = dt.date


def _run(spark, symbol, dates, run):
    body = doc(symbol, {d.isoformat(): day(10, 12, 9, 11, 100) for d in dates})
    return rec(symbol, body, at=dt.datetime.combine(run, dt.time(6)), run=run)


def span(start, n):
    return [start + dt.timedelta(days=i) for i in range(n)]


def test_stream_incremental_is_idempotent(spark):
    landing, target = new_path(spark, "landing"), new_path(spark, "target")
    # three runs; each re-fetches the previous run's last two days (lookback replays)
    records = [
        _run(spark, s, span(start, n), start + dt.timedelta(days=n))
        for s in ("IBM", "AAPL")
        for start, n in ((D(2026, 5, 1), 10), (D(2026, 5, 9), 10), (D(2026, 5, 17), 6))
    ]
    write_landing(landing_df(spark, records), landing)
    q = start_incremental_stream(spark, landing, target, new_path(spark, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    t = read_target(spark, target)
    assert t.count() == 2 * 22 and t.select("symbol", "bar_date").distinct().count() == 2 * 22
    # the stream's checkpoint is lost: everything is read again, nothing is added
    q = start_incremental_stream(spark, landing, target, new_path(spark, "ckpt"))
    q.awaitTermination()
    assert read_target(spark, target).count() == 2 * 22


def test_late_and_replayed_days_are_dropped(spark):
    landing, out, ckpt = new_path(spark, "landing"), new_path(spark, "dedup"), new_path(spark, "ckpt")
    write_landing(landing_df(spark, [_run(spark, "X", span(D(2026, 5, 10), 11), D(2026, 5, 20))]), landing)
    start_late_dedup_stream(spark, landing, out, ckpt).awaitTermination()
    # watermark is now 05-20 - 2 days: 05-17 is late, 05-19 a replay, 05-21 new
    later = _run(spark, "X", [D(2026, 5, 17), D(2026, 5, 19), D(2026, 5, 21)], D(2026, 5, 21))
    write_landing(landing_df(spark, [later]), landing)
    start_late_dedup_stream(spark, landing, out, ckpt).awaitTermination()
    got = sorted(r.bar_date for r in spark.read.parquet(out).collect())
    assert got == span(D(2026, 5, 10), 12)


def test_stream_equals_full_reload_if_replays_are_identical(spark):
    """The stream (micro-batches, anti-join, append) and the batch full reload (keep-last,
    overwrite) build the same table from the same landing, where no replay revises a value."""
    from candlelake.plans import run_full_reload
    from candlelake.queries import TARGET_COLUMNS
    from candlelake.sources import fixtures as X
    from candlelake.sources.landing import read_landing

    landing, streamed, batch = new_path(spark, "landing"), new_path(spark, "target"), new_path(spark, "target")
    write_landing(X.landing(spark, SF_SMALL), landing)
    start_incremental_stream(spark, landing, streamed, new_path(spark, "ckpt"), max_files_per_trigger=20).awaitTermination()
    run_full_reload(spark, read_landing(spark, landing), batch)
    a = read_target(spark, streamed).select(*TARGET_COLUMNS)
    b = read_target(spark, batch).select(*TARGET_COLUMNS)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_many_symbols_share_a_call_and_a_state(spark, monkeypatch):
    """Buckets of symbols: state rows and calls do not grow with the symbols, and each symbol keeps days of its own."""
    from candlelake.streaming import late_rows

    monkeypatch.setattr(late_rows, "BUCKETS", 2)
    landing, out, ckpt = new_path(spark, "landing"), new_path(spark, "late"), new_path(spark, "ckpt")
    symbols = [f"S{k}" for k in range(12)]
    write_landing(landing_df(spark, [_run(spark, s, span(D(2026, 5, 1 + k), 5), D(2026, 5, 30)) for k, s in enumerate(symbols)]), landing)
    late_rows.start_late_rows_stream(spark, landing, out, ckpt).awaitTermination()
    # a replay, a day that is too old for the later symbols, a new one, and a symbol that was not there
    again = [_run(spark, s, [D(2026, 5, 5 + k), D(2026, 5, 8), D(2026, 5, 25)], D(2026, 5, 31)) for k, s in enumerate(symbols)]
    write_landing(landing_df(spark, [*again, _run(spark, "T", [D(2026, 5, 1)], D(2026, 5, 31))]), landing)
    q = late_rows.start_late_rows_stream(spark, landing, out, ckpt)
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    want = {("T", D(2026, 5, 1), False)}
    for k, s in enumerate(symbols):
        days, newest = span(D(2026, 5, 1 + k), 5), D(2026, 5, 5 + k)
        want |= {(s, d, False) for d in [*days, D(2026, 5, 25)]}
        floor = newest - dt.timedelta(days=2)
        if D(2026, 5, 8) < floor:
            want.add((s, D(2026, 5, 8), True))
        elif D(2026, 5, 8) not in days:
            want.add((s, D(2026, 5, 8), False))
    got = [(r.symbol, r.bar_date, str(r.late).lower() == "true") for r in spark.read.parquet(out).collect()]
    assert len(got) == len(want) and set(got) == want
