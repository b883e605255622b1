"""The reference's documented SQL, verbatim, on spark.sql over our tables."""

import datetime as dt

from candlelake.plans import run_full_reload
from candlelake.session import new_path
from candlelake.sources import fixtures as X
from candlelake.sources.views import register_employees_view, register_target_view
from helpers import SF_SMALL


def test_reference_sql_on_stock_daily(spark):
    target = new_path(spark, "target")
    run_full_reload(spark, X.landing(spark, SF_SMALL), target)
    view = register_target_view(spark, target)
    assert view.columns[:2] == ["symbol", "date"]
    per_symbol = spark.sql("SELECT symbol, COUNT(*) FROM stock_daily GROUP BY symbol").collect()
    assert sum(r[1] for r in per_symbol) == view.count()
    latest = dict(spark.sql("SELECT symbol, MAX(date) FROM stock_daily GROUP BY symbol").collect())
    assert all(isinstance(d, dt.date) for d in latest.values())
    top = spark.sql("SELECT * FROM stock_daily ORDER BY date DESC LIMIT 10").collect()
    assert len(top) == 10 and top[0]["date"] == max(latest.values())


def test_reference_sql_on_employees(spark):
    register_employees_view(spark, X.employees(spark, SF_SMALL))
    rows = spark.sql("SELECT * FROM employees ORDER BY id;".rstrip(";")).collect()
    assert [r.id for r in rows] == sorted(r.id for r in rows)
    assert spark.sql("SELECT * FROM employees").count() == len(rows)


def test_missing_target_has_no_view(spark):
    assert register_target_view(spark, new_path(spark, "target"), name="nothing_here") is None
