"""Scale guards on the physical plans of every registered query."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sitewatch.plans import catalog

NAMES = sorted(catalog.queries())

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pairs_no_python_no_single_task_windows(spark, name):
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only allowed as the final step of a global aggregate
            assert "partial_" in lines[i + 1], f"{name}: single-partition exchange\n{plan}"


def _read_schema(plan, table):
    cols = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: [^\]]*" + table, plan):
        cols.append(set(m.group(1).split(",")))
    return cols


def test_column_pruning_reaches_scan(spark):
    plan = _plan(spark, "site_avg_hour")
    names = {re.sub(r"#\d+L?", "", c) for s in _read_schema(plan, "events") for c in s}
    assert names == {"ts", "user_id", "value", "props"}


def test_matcher_broadcasts_config_and_never_shuffles_reports(spark):
    plan = _plan(spark, "alarms")
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    # the one exchange belongs to the per-site config reduction
    assert plan.count("Exchange hashpartitioning") == 1


def test_averages_aggregate_partially_before_shuffle(spark):
    """Sums by group and bin first; what is shuffled again is one row per group and bins."""
    plan = _plan(spark, "site_avg_minute")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in plan


def _ran(spark, name):
    """The plan that ran, after adaptive planning."""
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _scans(plan):
    return plan.count("FileScan parquet")


def test_cutoff_comparison_reaches_the_scan(spark):
    plan = _plan(spark, "trailing_cutoff")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


@pytest.mark.parametrize("name", ["month_spine", "year_spine", "tier_purge", "avg_upsert"])
def test_one_scan(spark, name):
    assert _scans(_ran(spark, name)) == 1


def test_asof_join_reads_each_side_once(spark):
    assert _scans(_ran(spark, "config_asof_match")) <= 3


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith(("rollup", "site_avg"))])
def test_averages_are_plain_partial_aggregates(spark, name):
    """The readings meet a sum alone; only sums by bin are ever collected in a list."""
    plan = _plan(spark, name)
    assert "partial_sum" in plan and "SortAggregate" not in plan and "array_sort" not in plan
    lists = [line for line in plan.splitlines() if "partial_collect_list" in line]
    assert lists and all("_s_" in line or "_n_" in line for line in lists)
