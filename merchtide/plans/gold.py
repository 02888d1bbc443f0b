"""Decision tables built from silver."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchtide import model
from merchtide.functions import metrics as mt
from merchtide.functions.numeric import fixed_avg, fixed_sum, ratio, rounded
from merchtide.model import Thresholds
from merchtide.operators.columns import harmonize_numbers
from merchtide.operators.rank import ranked, top_k
from merchtide.operators.snapshot import at_latest, latest_time
from merchtide.plans.layers import Lake, read_silver
from merchtide.sources import tables
from merchtide.sources.audit import audited
from merchtide.sources.storage import staging

ACTION_COLUMNS = (
    "priority_rank", "sku", "product_name", "category", "action_type",
    "primary_channel_sequence", "reason", "suggested_budget_shift_pct",
    "keep_promoting_until_hour",
)
LOW_STOCK_COLUMNS = (
    "sku", "product_name", "category", "closing_stock", "stock_cover_hrs",
    "stock_risk_flag", "action_type",
)
GOLD_TABLES = (
    "main_dashboard_kpis", "category_demand_lift_current", "product_pushnow_current",
    "recommended_actions_current_hour", "channel_budget_shift_current",
)


def stamped(df: DataFrame, run_at: datetime | None = None) -> DataFrame:
    """Add the creation time; a given time makes reruns compare equal."""
    stamp = F.lit(run_at) if run_at else F.current_timestamp()
    return df.withColumn("created_at", stamp.cast("timestamp"))


def priority() -> list[Column]:
    """Push order; the product code ends it, so no two rows are equal."""
    return [
        F.col("push_score").desc(), F.col("roas").desc(), F.col("cvr_pct").desc(),
        F.col("sku").asc(),
    ]


def hourly_kpis(marketing: DataFrame) -> DataFrame:
    """Totals and ratios of totals per hour."""
    sums = marketing.groupBy("timestamp", "hour_key").agg(
        fixed_sum(F.col("gross_revenue")).alias("revenue_last_hour"),
        F.sum("orders").cast("long").alias("orders_last_hour"),
        F.sum("units_sold").cast("long").alias("units_last_hour"),
        F.sum("sessions").cast("long").alias("sessions_last_hour"),
        fixed_sum(F.col("ad_spend")).alias("_spend"),
        fixed_avg(F.col("demand_index")).alias("demand_pulse_index"),
    )
    return sums.select(
        "timestamp", "hour_key", "revenue_last_hour", "orders_last_hour", "units_last_hour",
        "sessions_last_hour",
        (ratio(F.col("orders_last_hour"), F.col("sessions_last_hour")) * 100.0)
        .alias("conversion_rate_pct"),
        ratio(F.col("revenue_last_hour"), F.col("_spend")).alias("roas"),
        "demand_pulse_index",
    )


def stock_totals(stock: DataFrame) -> DataFrame:
    return stock.groupBy("timestamp").agg(
        F.sum("closing_stock").cast("long").alias("stock_on_hand_total")
    )


def kpi_history(marketing: DataFrame, stock: DataFrame) -> DataFrame:
    """KPIs of every hour; an hour without stock rows has no stock total."""
    return hourly_kpis(marketing).join(stock_totals(stock), "timestamp", "left")


def main_kpis(
    marketing: DataFrame, stock: DataFrame, clock: Column | None = None, strict: bool = False
) -> DataFrame:
    """KPIs of the newest marketing hour; stock is taken at that same hour."""
    clock = latest_time(marketing) if clock is None else clock
    now = at_latest(marketing, clock=clock, strict=strict)
    return kpi_history(now, at_latest(stock, clock=clock)).select(
        "timestamp", "hour_key", "revenue_last_hour", "orders_last_hour", "units_last_hour",
        "sessions_last_hour", "conversion_rate_pct", "roas", "stock_on_hand_total",
        "demand_pulse_index",
    )


def category_lift(
    category: DataFrame, clock: Column | None = None, strict: bool = False
) -> DataFrame:
    return at_latest(category, clock=clock, strict=strict).select(
        "timestamp", "category", F.col("avg_demand_spike_pct").alias("demand_lift_pct"),
        "avg_push_score", "cvr_pct", "roas",
    )


def with_stock_and_product(
    marketing: DataFrame, stock: DataFrame, product: DataFrame
) -> DataFrame:
    """Marketing rows with the stock of the same hour and the product's margin."""
    held = stock.select("hour_key", "sku", "closing_stock", "stock_cover_hrs", "stock_risk_flag")
    return marketing.join(held, ["hour_key", "sku"], "left").join(
        product.select("sku", "margin_pct", "unit_price", "brand"), "sku", "left"
    )


def with_decision(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Decision, action, channel sequence and budget shift of each row."""
    return (
        df.withColumn(
            "decision",
            mt.decision(
                F.col("stock_cover_hrs"), F.col("roas"), F.col("cvr_pct"), F.col("margin_pct"), t
            ),
        )
        .withColumn("action_type", mt.action_type(F.col("decision")))
        .withColumn("primary_channel_sequence", mt.channel_sequence(F.col("action_type")))
        .withColumn("suggested_budget_shift_pct", mt.action_budget_shift(F.col("action_type")))
    )


def push_now(
    marketing: DataFrame, stock: DataFrame, product: DataFrame,
    t: Thresholds = Thresholds(), clock: Column | None = None,
) -> DataFrame:
    """Decisions of the newest hour, without the rank.

    Both facts are cut to the snapshot before they meet.
    """
    clock = latest_time(marketing) if clock is None else clock
    now = with_stock_and_product(
        at_latest(marketing, clock=clock), at_latest(stock, clock=clock), product
    )
    return with_decision(now, t)


def prioritized(decisions: DataFrame) -> DataFrame:
    """Every decision with its place in the push order."""
    return ranked(decisions, priority())


def recommended_actions(
    decisions: DataFrame, t: Thresholds = Thresholds(), fixed: bool = False
) -> DataFrame:
    """The best few decisions with a reason and an expiry.

    Takes decisions with or without a rank: without one only the best rows are
    ranked.
    """
    if "priority_rank" in decisions.columns:
        best = decisions.filter(F.col("priority_rank") <= t.action_limit)
    else:
        best = top_k(decisions, priority(), t.action_limit)
    return (
        best.withColumn(
            "reason",
            mt.reason(
                F.col("demand_spike_pct"), F.col("cvr_pct"), F.col("roas"),
                F.col("stock_cover_hrs"), fixed,
            ),
        )
        .withColumn("keep_promoting_until_hour", F.expr("timestamp + INTERVAL 3 HOURS"))
        .select(*ACTION_COLUMNS)
    )


def mean_roas(channel_now: DataFrame) -> Column:
    """Unweighted mean over channels, 0 when there are none."""
    return channel_now.agg(
        F.coalesce(fixed_avg(F.col("roas")), F.lit(0.0)).alias("mean")
    ).scalar()


def budget_shift(
    channel: DataFrame, clock: Column | None = None, strict: bool = False
) -> DataFrame:
    now = at_latest(channel, clock=clock, strict=strict)
    return (
        now.withColumn("_mean", mean_roas(now))
        .withColumn(
            "suggested_budget_shift_pct",
            mt.channel_budget_shift(F.col("roas"), F.col("_mean")),
        )
        .withColumn("budget_action", mt.budget_action(F.col("suggested_budget_shift_pct")))
        .drop("_mean")
    )


def low_stock(decisions: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    return decisions.filter(F.col("stock_cover_hrs") < t.stock_low_hrs).select(*LOW_STOCK_COLUMNS)


def orders_summary(marketing: DataFrame) -> DataFrame:
    """Per hour: totals, conversion and average order value."""
    sums = marketing.groupBy("timestamp", "hour_key").agg(
        F.sum("orders").cast("long").alias("total_orders"),
        F.sum("units_sold").cast("long").alias("total_units"),
        F.sum("sessions").cast("long").alias("total_sessions"),
        fixed_sum(F.col("gross_revenue")).alias("revenue"),
        fixed_sum(F.col("ad_spend")).alias("ad_spend"),
    )
    return sums.select(
        "*",
        mt.percent(F.col("total_orders"), F.col("total_sessions")).alias("conversion_rate_pct"),
        rounded(ratio(F.col("revenue"), F.col("total_orders")), 2).alias("aov"),
    )


def category_summary(marketing: DataFrame) -> DataFrame:
    """Per hour and category: totals, mean lift and score, conversion and ROAS."""
    sums = marketing.groupBy("timestamp", "hour_key", "category").agg(
        F.sum("sessions").cast("long").alias("sessions"),
        F.sum("orders").cast("long").alias("orders"),
        fixed_sum(F.col("gross_revenue")).alias("revenue"),
        fixed_sum(F.col("ad_spend")).alias("ad_spend"),
        rounded(fixed_avg(F.col("demand_spike_pct")), 1).alias("avg_demand_spike_pct"),
        rounded(fixed_avg(F.col("push_score")), 1).alias("avg_push_score"),
    )
    return sums.select(
        "*",
        mt.percent(F.col("orders"), F.col("sessions")).alias("cvr_pct"),
        rounded(ratio(F.col("revenue"), F.col("ad_spend")), 2).alias("roas"),
    )


def demand_vs_stock(marketing: DataFrame, stock: DataFrame) -> DataFrame:
    """Mean demand index and stock on hand per hour, oldest first."""
    held = stock.select("hour_key", "sku", "closing_stock")
    return (
        marketing.select("timestamp", "hour_key", "sku", "demand_index")
        .join(held, ["hour_key", "sku"])
        .groupBy("timestamp")
        .agg(
            fixed_avg(F.col("demand_index")).alias("demand_index"),
            F.sum("closing_stock").cast("long").alias("stock_on_hand"),
        )
        .orderBy("timestamp")
    )


def build_gold(
    spark: SparkSession, lake: Lake, t: Thresholds = Thresholds(),
    run_id: str | None = None, run_at: datetime | None = None, view: str | None = None,
) -> dict[str, int]:
    """Replace the gold tables from silver, and publish the low-stock view when named.

    The action table and the view read the written push table, so the joins and
    the rank run once.
    """
    run_id = run_id or str(uuid4())
    log = lake.table("ops", "etl_audit_log")
    marketing, stock, product, category, channel = (
        harmonize_numbers(read_silver(spark, lake, spec).select(*spec.columns))
        for spec in (
            model.MARKETING, model.STOCK, model.PRODUCT, model.CATEGORY_HOURLY,
            model.CHANNEL_HOURLY,
        )
    )
    # The newest hour by the folder names: the scans below open one hour's folders and
    # no others, and none to find the hour.
    hour = F.lit(tables.newest_partition(
        spark, lake.table("silver", model.MARKETING.target), "hour_key")).cast("string")
    marketing = marketing.filter(F.col("hour_key") == hour)
    stock = stock.filter(F.col("hour_key") == hour)
    category, channel = (at_latest(df, "hour_key") for df in (category, channel))
    counts = {}

    def write(name: str, df: DataFrame) -> None:
        counts[name] = tables.replace_table(stamped(df, run_at), lake.table("gold", name))

    with audited(spark, log, run_id, "build_gold", "gold_outputs") as outcome, staging(spark):
        write("main_dashboard_kpis", main_kpis(marketing, stock))
        write("category_demand_lift_current", category_lift(category))
        write(
            "product_pushnow_current", prioritized(push_now(marketing, stock, product, t))
        )
        pushed = tables.read_table(spark, lake.table("gold", "product_pushnow_current"))
        write("recommended_actions_current_hour", recommended_actions(pushed, t))
        write("channel_budget_shift_current", budget_shift(channel))
        if view:
            tables.publish_view(
                spark, view, lake.table("gold", "product_pushnow_current"), LOW_STOCK_COLUMNS,
                f"stock_cover_hrs < {float(t.stock_low_hrs)}",
            )
        outcome["row_count"] = counts["product_pushnow_current"]
    return counts
