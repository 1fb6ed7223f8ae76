"""Properties every registered plan must have to hold on a large cluster."""

import os
import re

import pytest

import __spark_entry__ as entry
from lexspark.plans.catalog import CATALOG

ROOT = os.environ.get("TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
PYTHON = {"zip_acts", "zip_maxims", "zip_acts_by_range", "zip_maxims_by_range", "xml_files"}
ONE_ROW = {"distinct_totals", "conditional_counts", "segment_totals", "dq_report", "share_of_total", "published_report"}


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_plan(spark, name):
    plan = entry.queries()[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    assert ("MapInArrow" in plan) == (name in PYTHON)
    # A window always has a partition key, and only global aggregates meet in a single task.
    assert not re.search(r"windowspecdefinition\((specifiedwindowframe|[^,]*(ASC|DESC))", plan)
    if name not in ONE_ROW:
        assert "Exchange SinglePartition" not in plan


def test_maps_without_shuffle(spark):
    for name in ("flagset_verdict", "revisions_table", "flatten_acts", "maxim_cross", "markup_clean", "segment_hierarchy", "zip_acts"):
        plan = entry.queries()[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
        # Small inputs are spread over the cores first; nothing else moves rows.
        assert re.findall(r"Exchange \w+", plan) in ([], ["Exchange RoundRobinPartitioning"])


def test_columns_are_pruned(spark):
    plan = entry.queries()["scorecard"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == [
        "c_custkey:bigint", "conv_id:bigint", "l_partkey:bigint", "o_custkey:bigint,o_orderstatus:string", "text:string", "user_id:bigint",
    ]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
