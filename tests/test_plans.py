"""Physical-plan guarantees of the registered queries."""

import re

import pytest

import __spark_entry__ as E
from strata.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(QUERIES[name](spark, SF_SMALL)) for name in QUERIES}


def test_no_cross_joins_or_python_udfs(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def _read_schema(plan: str, table: str) -> set:
    """Columns read by the scan of ``table`` (from the FileScan output list)."""
    m = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*?/" + table + r"\.parquet\]", plan)
    assert m, f"no scan of {table}"
    return {re.sub(r"#\d+L?$", "", c) for c in m.group(1).split(",")}


def test_lineitem_scan_is_pruned_for_the_flagship(spark):
    plan = E.queries()["clean_items"](spark, SF_SMALL)
    cols = _read_schema(_plan(plan), "lineitem")
    assert cols == {"l_partkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"}


def test_filters_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*value", plans["dq_range"])
    assert re.search(r"PushedFilters: \[[^\]]*p_size", plans["union_pages"])


BOUNDED_CHILDREN = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject",
                    "GlobalLimit", "CollectLimit")


def test_single_partition_exchanges_only_take_bounded_input(plans):
    """Every move to one partition (global aggregate, rank over the <= n
    threshold values, per-partition offsets) reads an aggregate or a top-k,
    never raw rows."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            child = next((ln for ln in lines[i + 1:] if re.search(r"\+- |:- ", ln)), "")
            op = re.sub(r"^[\s:|+\-]*", "", child).split("(")[0].split(" ")[0]
            assert op in BOUNDED_CHILDREN, f"{name}: SinglePartition over {op}"
