"""Physical-plan properties the design relies on (column pruning, pushdown, shuffle count,
hash-based aggregation)."""

import datetime as dt
import re

from candlelake import queries as Q
from candlelake.operators.bronze import flatten, merge_attempts
from candlelake.operators.gold import to_gold
from candlelake.operators.incremental import in_window, new_rows
from candlelake.operators.silver import dq_report, parse, to_silver
from candlelake.session import new_path
from candlelake.sources.fixtures import orders_bars
from candlelake.sources.landing import read_landing, write_landing
from candlelake.sources.tables import existing_keys
from helpers import SF_SMALL


def _executed(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated scans
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def _landed(spark):
    path = new_path(spark, "landing")
    write_landing(Q.landing(spark, SF_SMALL), path)
    return path


def test_orders_scan_reads_only_needed_columns(spark):
    plan = _executed(orders_bars(spark, SF_SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_totalprice"
    ]
    assert "SortAggregate" not in plan


def test_landing_to_gold_is_one_hash_shuffle(spark):
    lnd = read_landing(spark, _landed(spark))
    plan = _executed(to_gold(to_silver(flatten(lnd))))
    assert _hash_exchanges(plan) == 1
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert len(re.findall(r"parse_?json", plan, re.I)) == 1 and "from_json" not in plan  # a body is parsed once


def test_dq_report_is_one_hash_shuffle(spark):
    plan = _executed(dq_report(parse(flatten(read_landing(spark, _landed(spark))))))
    assert _hash_exchanges(plan) == 1 and "SortAggregate" not in plan


def test_attempt_merge_is_hash_based(spark):
    plan = _executed(merge_attempts(read_landing(spark, _landed(spark))))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_incremental_scans_are_pruned(spark):
    sc = Q.Scenario(spark, SF_SMALL)
    paths = sc.setup()
    ff = sc.fetch_from()
    incoming = in_window(to_silver(flatten(read_landing(spark, paths["landing"], ff.replace(day=1)))), ff)
    plan = _executed(new_rows(incoming, existing_keys(spark, paths["target"], ff)))
    assert re.search(r"PartitionFilters: \[[^\]]*run_date#\d+ >= " + ff.replace(day=1).isoformat(), plan)
    assert re.search(r"PartitionFilters: \[[^\]]*bar_month#\d+ >= " + ff.strftime("%Y-%m"), plan)
    assert f"GreaterThanOrEqual(bar_date,{ff.isoformat()})" in plan
    assert "ReadSchema: struct<symbol:string,bar_date:date>" in plan
    assert _hash_exchanges(plan) >= 1
    # the window filter runs before the keep-last shuffle
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "Filter" in before_shuffle and ff.isoformat() in before_shuffle


def test_first_run_window_is_100_days(spark):
    from candlelake.operators.incremental import fetch_window
    from candlelake.sources.tables import read_marks

    old, _, ff = fetch_window(spark, read_marks(spark, new_path(spark, "marks")), dt.date(2026, 5, 22)).first()
    assert old is None and ff == dt.date(2026, 2, 11)


def test_incremental_queries_parse_each_body_once(spark):
    for name in ("new_rows", "incremental_summary", "max_loaded_date"):
        plan = _executed(Q.QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(r"parse_?json", plan, re.I)) == 1 and "from_json" not in plan, name


def test_symbols_and_days_come_without_the_bars(spark):
    """The scenario's bounds and symbols are the bars', and are found without grouping the bars."""
    from pyspark.sql import functions as F

    from candlelake import queries as Q
    from helpers import SF_SMALL

    bounds = [F.max("bar_date"), F.min("symbol"), F.count_distinct("symbol")]
    assert Q.ticks(spark, SF_SMALL).agg(*bounds).first() == Q.bars(spark, SF_SMALL).agg(*bounds).first()
    plan = Q.ticks(spark, SF_SMALL).agg(*bounds[:2])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan, plan
