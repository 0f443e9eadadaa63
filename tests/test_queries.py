"""Every registered query against its SQL, over the whole smallest fixture."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from tests.compare import differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, SF)
    if name not in ORACLE:
        assert result.columns and result.count() > 0
        return
    assert differences(result, ORACLE[name], SF) == []


def test_probed_cells_hold_most_of_the_exact_neighbours(spark):
    key = lambda name: {(r.query_id, r.item_id) for r in QUERIES[name](spark, SF).collect()}
    exact = key("knn_topk")
    assert len(key("knn_index") & exact) >= 0.9 * len(exact)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_comparison_sees_a_changed_value(spark):
    name = "day_bounds"
    changed = QUERIES[name](spark, SF).selectExpr("nation + 1 AS nation", "first_day", "last_day")
    assert differences(changed, ORACLE[name], SF)


def test_entry_runs(spark):
    assert entry_module.entry(spark).limit(1).count() == 1


def test_no_query_plan_has_a_cross_join(spark):
    for name in ("category_week", "complete_grid", "range_lookup", "range_lookup_overlapping", "progression", "dialog_context"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_headline_plans_expand_no_rows(spark):
    for name in ("category_week", "daily_load_ratio", "session_summary", "week_balance"):
        assert "Expand" not in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString(), name
