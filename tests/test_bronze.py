import datetime as dt
import json
import os
import tempfile
from decimal import Decimal as D

from candlelake.operators.bronze import classify, entry_counts, flatten, merge_attempts
from candlelake.operators.silver import dq_report, duplicate_keys, null_counts, parse
from candlelake.session import new_path
from candlelake.sources.landing import read_landing, read_merged_documents, write_landing
from helpers import SERIES, day, doc, landing_df, rec

T0 = dt.datetime(2026, 5, 22, 6, 0)


def test_envelope_precedence(spark):
    records = [
        rec("A", json.dumps({"Information": "limit", "Error Message": "bad"})),
        rec("B", json.dumps({"Error Message": "bad"})),
        rec("C", json.dumps({"Meta Data": {}})),
        rec("D", doc("D", {"2026-05-18": day(1, 1, 1, 1, 1)}), status=500),
        rec("E", None),
        rec("F", doc("F", {"2026-05-18": day(1, 1, 1, 1, 1)})),
        rec("G", "not json at all"),
        rec("H", json.dumps({"Information": None, SERIES: {}})),  # a key counts whatever its value
        rec("I", doc("I", {"2026-05-18": day(1, 1, 1, 1, 1)})[:-20]),
        rec("J", json.dumps({SERIES: ["no", "object"]})),
    ]
    got = {r.symbol: r.status for r in classify(landing_df(spark, records)).collect()}
    assert got == {
        "A": "rate_limited", "B": "api_error", "C": "missing_series", "D": "http_error",
        "E": "http_error", "F": "ok", "G": "unparseable", "H": "rate_limited", "I": "unparseable", "J": "unparseable",
    }


def test_only_ok_responses_flatten(spark):
    records = [
        rec("A", json.dumps({"Information": "limit", SERIES: {"2026-05-18": day(1, 1, 1, 1, 1)}})),
        rec("F", doc("F", {"2026-05-18": day(1, 2, 1, 2, 7), "2026-05-19": day(2, 3, 2, 3, 8)})),
        rec("E", json.dumps({"Meta Data": {}, SERIES: {}})),  # empty series: ok, no rows
    ]
    rows = flatten(landing_df(spark, records)).collect()
    assert sorted((r.symbol, r.bar_date) for r in rows) == [("F", "2026-05-18"), ("F", "2026-05-19")]


def test_repeated_json_keys_last_wins(spark):
    body = (
        '{"Meta Data": {"2. Symbol": "X"}, "Time Series (Daily)": {'
        '"2026-05-18": {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "0"}, '
        '"2026-05-19": {"1. open": "5", "2. high": "6", "3. low": "4", "4. close": "5", "5. volume": "9", "5. volume": "10"}, '
        '"2026-05-18": {"1. open": "2", "2. high": "3", "3. low": "1", "4. close": "3", "5. volume": "7"}}}'
    )
    lnd = landing_df(spark, [rec("X", body)])
    got = {r.bar_date: r for r in flatten(lnd).collect()}
    assert len(got) == 2
    assert got["2026-05-18"].close == D("3") and got["2026-05-18"].volume == 7
    assert got["2026-05-19"].volume == 10
    counts = {r.bar_date: r for r in entry_counts(lnd).collect()}
    assert counts["2026-05-18"].n_entries == 2
    assert counts["2026-05-18"].close_first == D("1") and counts["2026-05-18"].close == D("3")
    assert counts["2026-05-19"].n_entries == 1


def test_bad_values_become_null_and_are_reported(spark):
    days = {
        "2026-05-18": day("NaN", 2, 1, 2, 5),
        "2024-1-5": day(1, 2, 1, 2, ""),
        "2026-05-19": day(1, 2, 1, 2, 5),
    }
    lnd = landing_df(spark, [rec("X", doc("X", days)), rec("X", doc("X", {"2026-05-19": day(1, 2, 1, 2, 5)}), at=T0 + dt.timedelta(hours=1))])
    silver = parse(flatten(lnd))
    assert silver.count() == 4  # never dropped
    assert silver.filter("bar_date IS NULL").count() == 1
    n = null_counts(silver).first()
    assert (n.open_nulls, n.volume_nulls, n.high_nulls) == (1, 1, 0)
    d = duplicate_keys(silver).first()
    assert (d.duplicate_keys, d.duplicate_rows) == (1, 2)
    report = {(r.check, r.column): (r.failures, r.status) for r in dq_report(silver).collect()}
    assert report[("not_null", "open")] == (1, "FAIL")
    assert report[("not_null", "close")] == (0, "PASS")
    assert report[("unique_key", "symbol,bar_date")] == (1, "FAIL")


def test_merge_attempts_last_ok_wins(spark):
    run = dt.date(2026, 5, 1)
    records = [
        rec("X", json.dumps({"Information": "limit"}), at=T0, run=run),
        rec("X", doc("X", {"2026-05-18": day(1, 1, 1, 1, 1)}), at=T0 + dt.timedelta(hours=1), run=run),
        rec("X", json.dumps({"Information": "limit"}), at=T0 + dt.timedelta(hours=2), run=run),
        rec("Y", json.dumps({"Error Message": "bad"}), at=T0, run=run),
    ]
    got = {r.symbol: r for r in merge_attempts(landing_df(spark, records)).collect()}
    assert (got["X"].n_attempts, got["X"].n_ok, got["X"].status) == (3, 1, "ok")
    assert (got["Y"].status, got["Y"].n_ok) == ("api_error", 0)


def test_landing_roundtrip_and_pruning(spark):
    path = new_path(spark, "landing")
    records = [
        rec("X", doc("X", {"2026-04-30": day(1, 1, 1, 1, 1)}), run=dt.date(2026, 4, 1)),
        rec("X", doc("X", {"2026-05-18": day(1, 1, 1, 1, 1)}), run=dt.date(2026, 5, 1)),
    ]
    write_landing(landing_df(spark, records), path)
    assert "run_date=2026-04-01" in os.listdir(path)
    back = read_landing(spark, path, runs_from=dt.date(2026, 5, 1))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "run_date" in plan
    assert [r.bar_date for r in flatten(back).collect()] == ["2026-05-18"]


def test_merged_document_reader(spark):
    folder = tempfile.mkdtemp(prefix="merged-")
    merged = {
        "IBM": {"Meta Data": {"2. Symbol": "IBM"}, SERIES: {"2026-05-18": day("218.55", "223.33", "217.75", "222.75", 5946367)}},
        "AAPL": {"Meta Data": {"2. Symbol": "AAPL"}, SERIES: {"2026-05-18": day("300.24", "300.66", "294.91", "297.84", 34482959)}},
    }
    with open(os.path.join(folder, "stock_market.json"), "w") as f:
        json.dump(merged, f, indent=4)
    rows = flatten(read_merged_documents(spark, folder)).collect()
    assert sorted((r.symbol, r.close) for r in rows) == [("AAPL", D("297.84")), ("IBM", D("222.75"))]


def test_merged_document_repeated_symbol_last_wins(spark):
    folder = tempfile.mkdtemp(prefix="merged-")
    text = (
        '{"IBM": {"Time Series (Daily)": {"2026-05-18": {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "1"}}}, '
        '"IBM": {"Time Series (Daily)": {"2026-05-18": {"1. open": "2", "2. high": "2", "3. low": "2", "4. close": "2", "5. volume": "2"}}}}'
    )
    with open(os.path.join(folder, "stock_market.json"), "w") as f:
        f.write(text)
    rows = flatten(read_merged_documents(spark, folder)).collect()
    assert [(r.symbol, r.close) for r in rows] == [("IBM", D("2"))]


def test_cli_full_reload_and_dq(spark, capsys):
    from candlelake.__main__ import main

    landing, target = new_path(spark, "landing"), new_path(spark, "target")
    write_landing(landing_df(spark, [rec("X", doc("X", {"2026-05-18": day(1, 2, 1, 2, 5)}))]), landing)
    import unittest.mock as mock

    with mock.patch.object(type(spark), "stop", lambda self: None):
        main(["full-reload", "--landing", landing, "--target", target])
        main(["dq-report", "--landing", landing])
    out = capsys.readouterr().out.strip().splitlines()
    assert json.loads(out[0])["rows"] == 1
    assert len(json.loads(out[1])["checks"]) == 7


def test_parquet_landing_roundtrip(spark):
    path = new_path(spark, "landing")
    records = [rec("X", doc("X", {"2026-05-18": day(1, 2, 1, 2, 5)}), run=dt.date(2026, 5, 1))]
    write_landing(landing_df(spark, records), path, fmt="parquet")
    back = read_landing(spark, path, runs_from=dt.date(2026, 5, 1), fmt="parquet")
    assert [(r.symbol, r.bar_date, r.volume) for r in flatten(back).collect()] == [("X", "2026-05-18", 5)]


def test_null_symbol_rows_are_not_merged(spark):
    from candlelake.operators.silver import to_silver

    records = [
        rec(None, doc("A", {"2026-05-18": day(1, 1, 1, 1, 1)}), at=T0),
        rec(None, doc("B", {"2026-05-18": day(2, 2, 2, 2, 2)}), at=T0 + dt.timedelta(hours=1)),
        rec("X", doc("X", {"2026-05-18": day(3, 3, 3, 3, 3)}), at=T0),
        rec("X", doc("X", {"2026-05-18": day(4, 4, 4, 4, 4)}), at=T0 + dt.timedelta(hours=1)),
    ]
    got = sorted((r.symbol or "", r.volume) for r in to_silver(flatten(landing_df(spark, records))).collect())
    assert got == [("", 1), ("", 2), ("X", 4)]  # NULL-symbol rows kept whole; X keeps its last copy


def test_a_bad_day_costs_only_itself(spark):
    from candlelake.operators.bronze import rejects

    days = {"2026-05-21": "oops", "2026-05-22": [1], "2026-05-23": None, "2026-05-24": day(1, 2, 1, 2, 5), "2026-5-25": day(1, 2, 1, 2, 5)}
    run = dt.date(2026, 5, 25)
    records = [rec("X", doc("X", days), run=run), rec("Y", doc("Y", days)[:-9], run=run), rec(None, doc("Z", {"2026-05-24": day(1, 1, 1, 1, 1)}), run=run), rec("W", None, status=500)]
    lnd = landing_df(spark, records)
    assert sorted((r.symbol or "", r.bar_date) for r in flatten(lnd).collect()) == [("", "2026-05-24"), ("X", "2026-05-24"), ("X", "2026-5-25")]
    got = sorted((r.symbol or "", r.bar_date or "", r.reason) for r in rejects(lnd).collect())
    assert got == [
        ("", "2026-05-24", "null_symbol"), ("X", "2026-05-21", "bad_day"), ("X", "2026-05-22", "bad_day"), ("X", "2026-05-23", "bad_day"),
        ("X", "2026-5-25", "bad_date"), ("Y", "", "unparseable_body"),
    ]
    assert rejects(lnd).select("reject_id").distinct().count() == len(got)


def test_copy_without_fetch_time_loses_and_blanks_nothing(spark):
    from candlelake.operators.silver import to_silver

    records = [
        rec("X", doc("X", {"2026-05-18": day(1, 1, 1, 1, 1)}), at=T0),
        ("X", None, 200, doc("X", {"2026-05-18": day(9, 9, 9, 9, 9), "2026-05-19": day(2, 2, 2, 2, 2)}), T0.date()),
    ]
    got = {r.bar_date.day: r for r in to_silver(flatten(landing_df(spark, records))).collect()}
    assert (got[18].volume, got[18].n_copies, got[19].volume, got[19].close) == (1, 2, 2, D("2"))


def test_overflowing_prices_are_counted(spark):
    from candlelake.plans import run_full_reload

    days = {"2026-05-18": day("12345678.9", "1e9", 1, 2, 5), "2026-05-19": day("NaN", "", 1, 2, 5)}
    m = run_full_reload(spark, landing_df(spark, [rec("X", doc("X", days))]), new_path(spark, "target"))
    assert (m["rows"], m["overflows"], m["null_open"], m["null_high"]) == (2, 2, 2, 2)


def test_winning_response_has_its_body(spark):
    from candlelake.operators.bronze import winning_responses

    run = dt.date(2026, 5, 1)
    good = [doc("X", {"2026-05-18": day(k, k, k, k, k)}) for k in (1, 2)]
    records = [
        rec("X", good[0], at=T0, run=run), rec("X", good[1], at=T0 + dt.timedelta(hours=1), run=run),
        rec("X", json.dumps({"Information": "limit"}), at=T0 + dt.timedelta(hours=2), run=run),
        rec("Y", json.dumps({"Error Message": "a"}), at=T0, run=run), rec("Y", json.dumps({"Error Message": "b"}), at=T0, run=run),
        ("Z", None, 200, good[0], run),
        rec(None, good[1], run=run),
    ]
    got = {r.symbol: r for r in winning_responses(landing_df(spark, records + records[:1])).collect()}
    assert got["X"].body == good[1] and got["X"].status == "ok"
    assert got["Y"].status == "api_error" and got["Z"].body == good[0] and got[None].body == good[1]


def test_copies_without_a_fetch_time_are_told_apart_by_their_values(spark):
    from candlelake.operators.silver import to_silver

    records = [("X", None, 200, doc("X", {"2026-05-18": day(k, k, k, k, k)}), T0.date()) for k in range(1, 9)]
    kept = {to_silver(flatten(landing_df(spark, order).repartition(n))).first().volume for order in (records, records[::-1]) for n in (1, 3, 8)}
    assert len(kept) == 1
