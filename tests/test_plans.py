"""Plan regressions: the physical shapes the design relies on (read with explain('formatted'))."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from dqforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# queries that write files or fit models at build time are planned like the others; the training-data
# operators may run Arrow batches; tests/llm looks at the plans of the native ones
NAMES = sorted(QUERIES)


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(E.queries()[n](spark, SF)) for n in NAMES}


def test_no_cross_joins_or_python_rows(plans):
    for name, plan in plans.items():
        for node in FORBIDDEN:
            assert node not in plan, f"{name} plans {node}"


def test_fused_checks_have_no_expand_and_prune_columns(plans):
    for name in ("column_checks", "table_checks", "run_checks", "suite_validate", "batch_validate"):
        assert "Expand" not in plans[name], name
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plans["table_checks"])
    assert scans == ["l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double"]


def test_filters_reach_the_scan(plans):
    assert "In(n_nationkey" in plans["ground_truth_check"]
    assert re.search(r"PushedFilters: \[Or\(And\(GreaterThanOrEqual\(ts", plans["interval_check"])
    assert re.search(r"PushedFilters: \[Or\(And\(GreaterThanOrEqual\(ts", plans["metric_by_date"])
    assert "GreaterThanOrEqual(o_orderdate" in plans["publish_new"]


def test_spot_check_is_top_n_plus_broadcast_semi_join(plans):
    p = plans["spot_check"]
    assert "TakeOrderedAndProject" in p and "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "rangepartitioning" not in p  # no global sort


def test_ground_truth_broadcasts_only_the_literal_side(plans):
    p = plans["ground_truth_check"]
    assert "BroadcastHashJoin" in p
    # the data side is filtered by the key list and never hash-partitioned for the inner join
    inner = p.split("BroadcastHashJoin")[1].split("\n")[0]
    assert "Inner" in inner or "Inner" in p


def test_best_run_is_top_1(plans):
    assert "TakeOrderedAndProject" in plans["best_run"]


def test_latest_day_is_a_pushed_range(spark):
    from dqforge.plans.queries import q_latest_batch

    plan = q_latest_batch(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan and plan.count("FileScan parquet") == 1
