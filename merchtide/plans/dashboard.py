"""Dashboard queries. Orders end with a unique column, so ties can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Columns and leading order of each drill-down.
DRILLDOWNS = {
    "revenue": (
        ("product_name", "category", "gross_revenue", "margin_pct", "roas", "stock_cover_hrs",
         "push_score", "action_type", "decision"),
        "gross_revenue",
    ),
    "orders": (
        ("product_name", "category", "orders", "units_sold", "cvr_pct", "demand_spike_pct",
         "stock_cover_hrs", "push_score", "action_type", "decision"),
        "orders",
    ),
    "conversion": (
        ("product_name", "category", "cvr_pct", "roas", "demand_spike_pct", "stock_cover_hrs",
         "push_score", "action_type", "decision"),
        "cvr_pct",
    ),
    "roas": (
        ("product_name", "category", "roas", "gross_revenue", "ad_spend", "demand_spike_pct",
         "stock_cover_hrs", "push_score", "action_type", "decision"),
        "roas",
    ),
    "stock": (
        ("product_name", "category", "closing_stock", "stock_cover_hrs", "stock_risk_flag",
         "demand_spike_pct", "push_score", "action_type", "decision"),
        "stock_cover_hrs",
    ),
}
PUSH_COLUMNS = (
    "priority_rank", "sku", "product_name", "category", "demand_spike_pct", "cvr_pct", "roas",
    "stock_cover_hrs", "push_score", "action_type", "decision",
)


def latest_kpi(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy(F.col("timestamp").desc()).limit(1)


def lift_board(lift: DataFrame) -> DataFrame:
    return lift.orderBy(F.col("demand_lift_pct").desc(), "category")


def push_board(push: DataFrame) -> DataFrame:
    return push.select(*PUSH_COLUMNS).orderBy("priority_rank")


def action_board(actions: DataFrame) -> DataFrame:
    return actions.orderBy("priority_rank")


def drilldown(push: DataFrame, name: str) -> DataFrame:
    columns, lead = DRILLDOWNS[name]
    return push.orderBy(F.col(lead).desc(), F.col("push_score").desc(), "sku").select(*columns)


def budget_board(shift: DataFrame) -> DataFrame:
    return shift.orderBy(F.col("roas").desc(), "channel")


def quality_board(results: DataFrame) -> DataFrame:
    return results.orderBy(F.col("checked_at").desc(), "table_name", "rule_name")


def transaction_log(transactions: DataFrame) -> DataFrame:
    return transactions.orderBy("order_timestamp", "sku", "order_id")
