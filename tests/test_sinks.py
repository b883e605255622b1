import datetime as dt
import glob
import os
from decimal import Decimal as D

from candlelake.operators.conform import conform
from candlelake.plans import run_full_reload
from candlelake.session import new_path
from candlelake.sources import fixtures as X
from candlelake.sources.tables import read_target
from helpers import SF_SMALL

GOLD = (
    "symbol string, bar_date date, open decimal(12,4), high decimal(12,4), low decimal(12,4), "
    "close decimal(12,4), volume bigint, daily_range decimal(12,4), daily_return_pct decimal(20,4), candle string"
)


def test_conform_flags_and_casts(spark):
    rows = [
        ("IBM", dt.date(2026, 5, 18), D("1"), D("2"), D("1"), D("2"), 5, D("1"), D("100"), "Bullish"),
        ("4-NOT SPECIFIED", dt.date(2026, 5, 18), D("1"), D("2"), D("1"), D("2"), 5, D("1"), D("100"), "Bullish"),
        ("IBM", None, D("1"), D("2"), D("1"), D("2"), 5, D("1"), D("100"), "Bullish"),
        ("MSFT", dt.date(2026, 5, 18), D("1"), D("2"), D("1"), D("2"), 5, D("1"), D("12345678.0000"), "Bearish"),
    ]
    got = conform(spark.createDataFrame(rows, GOLD)).collect()
    assert [r.violation for r in got] == [None, "symbol_too_long", "null_key", None]
    assert got[3].daily_return_pct is None  # does not fit DECIMAL(10,4): NULL, row kept
    assert dict(conform(spark.createDataFrame(rows, GOLD)).dtypes)["open"] == "decimal(10,4)"


def test_full_reload_layout_and_overwrite(spark):
    target = new_path(spark, "target")
    m1 = run_full_reload(spark, X.landing(spark, SF_SMALL), target)
    m2 = run_full_reload(spark, X.landing(spark, SF_SMALL), target)  # a reload replaces, never appends
    assert m1["rows"] == m2["rows"] == read_target(spark, target).count()
    months = [d for d in os.listdir(target) if d.startswith("bar_month=")]
    assert len(months) > 12
    files_per_month = [len(glob.glob(os.path.join(target, d, "*.parquet"))) for d in months]
    assert max(files_per_month) <= 2  # rebalanced: few files per month
    assert m1["duplicate_keys"] > 0 and m1["violations"] > 0  # replays and long symbols are reported


def test_jdbc_missing_table_detection():
    from candlelake.sinks.targets import JdbcTarget

    t = JdbcTarget("jdbc:none://", "stock_daily")
    assert t._missing(Exception("java.sql.SQLSyntaxErrorException: Table 'db.stock_daily' doesn't exist"))
    assert t._missing(Exception('org.postgresql.util.PSQLException: ERROR: relation "stock_daily" does not exist'))
    assert t._missing(Exception("SQLSTATE 42X05"))
    assert not t._missing(Exception("password authentication failed for user"))
