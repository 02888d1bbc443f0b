"""What the plans of the main queries must and must not contain."""

import pytest

from merchtide import model, queries

LAZY = [
    "flow04_kpi_history", "flow06_push_history", "flow08_budget_shift", "agg10_category_summary",
    "ded01_newest_per_key", "jn05_upsert_rows", "win05_channel_share", "dq02_unique_key",
    "agg07_demand_vs_stock", "met06_order_value",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_joins_and_no_python(spark, data, name):
    plan = plan_of(queries.QUERIES[name](spark, data.folder))
    for banned in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval"):
        assert banned not in plan


def test_scan_reads_only_what_it_needs(spark, data):
    plan = plan_of(data.marketing.select("hour_key", "sku", "clicks"))
    assert "props" not in plan
    assert plan_of(data.restock).count("p_retailprice") == 0


def test_no_single_task_window(spark, data):
    for name in LAZY:
        plan = plan_of(queries.QUERIES[name](spark, data.folder))
        for line in plan.splitlines():
            if "Window [" in line:
                assert "[sku" in line


def test_dedupe_reduces_before_the_shuffle(spark, data):
    plan = plan_of(queries.QUERIES["ded01_newest_per_key"](spark, data.folder))
    assert "partial_max" in plan


def test_registry_and_rules_are_complete():
    assert {s.target for s in model.REGISTRY} >= {
        "dim_product", "fact_marketing_performance_hourly", "fact_stock_movement_hourly",
        "fact_order_transactions"}
    for spec in model.REGISTRY:
        assert spec.keys and set(spec.keys) <= set(spec.columns)
        assert set(spec.cluster_by) | set(spec.partition_by) | set(spec.required) <= set(spec.columns)
    assert set(model.PROCESS_RESOURCES) >= {e.process for e in model.STARTER_KNOWLEDGE}
