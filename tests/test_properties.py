"""Property tests (few examples each: every example runs Spark jobs)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlelake.operators.bronze import flatten
from candlelake.operators.incremental import new_rows
from candlelake.operators.silver import to_silver
from candlelake.sources.fixtures import landing_from_bars
from candlelake.schemas import BRONZE_COLUMNS

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

price = st.decimals(min_value=Decimal("0.0001"), max_value=Decimal("999999.9999"), places=4)
bar = st.tuples(
    st.sampled_from(["IBM", "AAPL", "MSFT"]),
    st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 12, 31)),
    price, price, price, price,
    st.integers(min_value=0, max_value=10**12),
)
BAR_SCHEMA = "symbol string, bar_date date, open decimal(10,4), high decimal(10,4), low decimal(10,4), close decimal(10,4), volume bigint"


def _unique(bars):
    seen = {}
    for b in bars:
        seen[(b[0], b[1])] = b
    return list(seen.values())


@SETTINGS
@given(st.lists(bar, min_size=1, max_size=40))
def test_flatten_of_nested_is_identity(spark, bars):
    """bars -> landed responses (replays, repeated keys, junk days) -> bronze -> silver gives
    back every bar once; junk days come back as NULLs."""
    bars = _unique(bars)
    df = spark.createDataFrame(bars, BAR_SCHEMA)
    silver = to_silver(flatten(landing_from_bars(df))).select(*BRONZE_COLUMNS)
    got = {(r.symbol, r.bar_date): r for r in silver.collect()}
    assert set(got) == {(b[0], b[1]) for b in bars}
    for s, d, o, h, lo, c, v in bars:
        r = got[(s, d)]
        assert r.open == (None if d.day == 13 else o)
        assert r.high == (None if d.day == 29 else h)
        assert (r.low, r.close) == (lo, c)
        assert r.volume == (None if d.day == 17 else v)


keys = st.lists(
    st.tuples(st.sampled_from(["A", "B", None]), st.one_of(st.none(), st.dates(dt.date(2026, 5, 1), dt.date(2026, 5, 6)))),
    max_size=25,
)


@SETTINGS
@given(keys, keys)
def test_anti_join_partitions_incoming(spark, incoming, existing):
    """new ∪ matched = incoming (as a multiset), and replaying new against existing ∪ new adds nothing."""
    schema = "symbol string, bar_date date"
    inc = spark.createDataFrame(incoming, schema)
    ex = spark.createDataFrame(existing, schema)
    new = [tuple(r) for r in new_rows(inc, ex).collect()]
    present = {k for k in existing if k[0] is not None and k[1] is not None}
    expected_new = [k for k in incoming if not (k[0] is not None and k[1] is not None and k in present)]
    assert sorted(new, key=str) == sorted(expected_new, key=str)
    after = ex.unionByName(spark.createDataFrame(new, schema))
    replay = new_rows(inc, after).collect()
    assert all(r.symbol is None or r.bar_date is None for r in replay)
