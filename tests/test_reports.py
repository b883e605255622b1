import datetime as dt
from decimal import Decimal

from candlelake.operators.reports import fixed_width_report, labelled_report, latest_bars, ordered_scan, preview
from candlelake.schemas import EMPLOYEES

# Employee rows shaped like the reference's seed table (invented names).
SEED = [
    (1, "Ada North", "Engineering", Decimal("75000.00"), dt.date(2023, 1, 15)),
    (2, "Ben Ortiz", "Marketing", Decimal("55000.00"), dt.date(2022, 6, 1)),
    (3, "A name longer than fifteen", "Engineering", Decimal("80000.00"), dt.date(2021, 3, 20)),
]


def test_fixed_width_matches_python_format(spark):
    got = {r.id: r.line for r in fixed_width_report(spark.createDataFrame(SEED, EMPLOYEES)).collect()}
    assert got == {
        1: "1     Ada North       Engineering     75000.00   2023-01-15",
        2: "2     Ben Ortiz       Marketing       55000.00   2022-06-01",
        3: "3     A name longer than fifteen Engineering     80000.00   2021-03-20",  # pads, never truncates
    }


def test_ordered_scan_is_in_order(spark):
    rows = [(i, f"n{i}") for i in (5, 3, 9, 1, 7, 2)]
    df = spark.createDataFrame(rows, "id int, name string").repartition(4)
    assert [r.id for r in ordered_scan(df, "id").collect()] == [1, 2, 3, 5, 7, 9]


def test_labelled_line(spark):
    df = spark.createDataFrame([(1, "Cleo"), (2, "Dev")], "id int, name string")
    assert [r.line for r in labelled_report(df).orderBy("id").collect()] == ["ID: 1 | Name: Cleo", "ID: 2 | Name: Dev"]


def test_topk_and_preview_are_deterministic(spark):
    rows = [(s, dt.date(2026, 5, d)) for s in ("B", "A", "C") for d in range(1, 6)]
    df = spark.createDataFrame(rows, "symbol string, bar_date date")
    top = [(r.symbol, r.bar_date.day) for r in latest_bars(df, 4).collect()]
    assert top == [("A", 5), ("B", 5), ("C", 5), ("A", 4)]
    assert "TakeOrderedAndProject" in latest_bars(df, 4)._jdf.queryExecution().executedPlan().toString()
    assert [(r.symbol, r.bar_date.day) for r in preview(df, 2).collect()] == [("A", 1), ("A", 2)]
