from decimal import Decimal as D

from candlelake.operators.bronze import flatten
from candlelake.operators.gold import candle_edges, to_gold
from candlelake.operators.silver import to_silver
from helpers import day, doc, landing_df, rec

# Golden gold rows of the reference's documentation (derived columns recomputed and equal).
GOLDEN = [
    ("IBM", "2026-05-18", "218.55", "223.33", "217.75", "222.75", 5946367, "5.58", "1.92", "Bullish"),
    ("AAPL", "2026-05-18", "300.24", "300.66", "294.91", "297.84", 34482959, "5.75", "-0.80", "Bearish"),
    ("MSFT", "2026-05-18", "432.10", "438.50", "430.20", "436.90", 18921000, "8.30", "1.11", "Bullish"),
]


def _gold_from_docs(spark, records):
    return to_gold(to_silver(flatten(landing_df(spark, records))))


def test_golden_rows(spark):
    records = [rec(s, doc(s, {d: day(o, h, l, c, v)})) for s, d, o, h, l, c, v, *_ in GOLDEN]
    got = {r.symbol: r for r in _gold_from_docs(spark, records).collect()}
    assert len(got) == 3
    for s, d, o, h, l, c, v, rng, ret, cnd in GOLDEN:
        r = got[s]
        assert str(r.bar_date) == d
        assert (r.open, r.high, r.low, r.close, r.volume) == (D(o), D(h), D(l), D(c), v)
        assert r.daily_range == D(rng)
        assert r.daily_return_pct == D(ret)
        assert r.candle == cnd


def test_gold_types(spark):
    records = [rec("IBM", doc("IBM", {"2026-05-18": day(1, 2, 0.5, 1.5, 10)}))]
    types = dict(_gold_from_docs(spark, records).dtypes)
    assert types == {
        "symbol": "string", "bar_date": "date", "open": "decimal(10,4)", "high": "decimal(10,4)",
        "low": "decimal(10,4)", "close": "decimal(10,4)", "volume": "bigint",
        "daily_range": "decimal(10,4)", "daily_return_pct": "decimal(10,4)", "candle": "string",
    }


def test_rounding_is_decimal_half_up(spark):
    # 1.005 and 0.285 are where binary doubles round the other way.
    records = [rec("X", doc("X", {"2026-05-18": day("100", "101.005", "100", "100.285", 1)}))]
    r = _gold_from_docs(spark, records).first()
    assert r.daily_range == D("1.01")
    assert r.daily_return_pct == D("0.29")


def test_edge_prices(spark):
    days = {
        "2026-05-11": day("0", "1", "0", "1", 1),  # open = 0: no return
        "2026-05-12": day("5", "6", "4", "5", 1),  # doji: Bearish
        "2026-05-13": day("NaN", "6", "4", "5", 1),  # NaN open: NULL, Bearish
        "2026-05-14": day("5", "12345678.9", "4", "5", 1),  # above DECIMAL(10,4): NULL
    }
    got = {str(r.bar_date): r for r in _gold_from_docs(spark, [rec("X", doc("X", days))]).collect()}
    assert got["2026-05-11"].daily_return_pct is None and got["2026-05-11"].candle == "Bullish"
    assert got["2026-05-12"].candle == "Bearish" and got["2026-05-12"].daily_return_pct == D("0")
    assert got["2026-05-13"].open is None and got["2026-05-13"].candle == "Bearish"
    assert got["2026-05-14"].high is None and got["2026-05-14"].daily_range is None


def test_candle_edges(spark):
    silver = to_silver(flatten(landing_df(spark, [rec("X", doc("X", {"2026-05-18": day(10, 12, 9, 11, 1)}))])))
    got = {r.variant: r for r in candle_edges(silver).collect()}
    assert got["as_landed"].candle == "Bullish" and got["as_landed"].daily_return_pct == D("10")
    assert got["null_open"].candle == "Bearish" and got["null_open"].daily_return_pct is None
    assert got["doji"].candle == "Bearish" and got["doji"].daily_return_pct == D("0")
    assert got["zero_open"].candle == "Bullish" and got["zero_open"].daily_return_pct is None


def test_recorded_run_300_bars_all_checks_pass(spark):
    """4 symbols requested, 1 rate-limited, 100 bars each for the others: 300 rows, checks pass."""
    import datetime as dt
    import json

    from candlelake.operators.silver import dq_report, parse

    start = dt.date(2026, 1, 1)
    records = [
        rec(s, doc(s, {(start + dt.timedelta(days=i)).isoformat(): day(100 + i, 102 + i, 99 + i, 101 + i, 1000 + i) for i in range(100)}))
        for s in ("IBM", "AAPL", "MSFT")
    ] + [rec("GOOGL", json.dumps({"Information": "rate limit"}))]
    bronze = flatten(landing_df(spark, records))
    assert bronze.count() == 300
    report = dq_report(parse(bronze)).collect()
    assert {r.status for r in report} == {"PASS"} and len(report) == 7
    assert _gold_from_docs(spark, records).count() == 300
