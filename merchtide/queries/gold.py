"""Snapshot, decision, dashboard, rollup and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchtide.functions import metrics as mt
from merchtide.functions.numeric import units
from merchtide.operators.columns import harmonize_numbers
from merchtide.operators.dedupe import keep_newest
from merchtide.operators.ledger import share_of_total
from merchtide.operators.rank import percentiles, ranked
from merchtide.operators.snapshot import at_latest
from merchtide.plans import dashboard as db
from merchtide.plans import gold
from merchtide.queries import query
from merchtide.queries.twin import avg2, rnd, sql


def decisions(d) -> DataFrame:
    """Decisions of every slot."""
    return gold.with_decision(gold.with_stock_and_product(d.marketing, d.stock, d.product))


def push(d) -> DataFrame:
    return gold.push_now(d.marketing, d.stock, d.product, clock=d.clock)


KEY = "hour_key, sku"


# --- projections and filters ----------------------------------------------


@query("prj04_latest_snapshot", sql(
    "SELECT * FROM mkt WHERE timestamp = (SELECT t FROM now_)"))
def _(d):
    return at_latest(d.marketing)


@query("prj05_strict_snapshot", sql(
    "SELECT channel, revenue FROM chl"))
def _(d):
    return at_latest(d.channel, strict=True).select("channel", "revenue")


@query("prj06_low_stock_rows", sql(
    f"SELECT {KEY}, closing_stock, stock_cover_hrs FROM stk WHERE stock_cover_hrs < 12"))
def _(d):
    low = d.stock.filter(F.col("stock_cover_hrs") < 12.0)
    return low.select("hour_key", "sku", "closing_stock", "stock_cover_hrs")


@query("prj07_decision_ladder", sql(f"SELECT {KEY}, decision FROM dec"))
def _(d):
    return decisions(d).select("hour_key", "sku", "decision")


@query("prj08_action_type", sql(f"SELECT {KEY}, action_type FROM dec"))
def _(d):
    return decisions(d).select("hour_key", "sku", "action_type")


@query("prj09_channel_sequence", sql(
    "SELECT action_type, primary_channel_sequence, COUNT(*) AS row_count FROM dec GROUP BY 1, 2"))
def _(d):
    return decisions(d).groupBy("action_type", "primary_channel_sequence").agg(
        F.count("*").alias("row_count"))


@query("prj10_action_budget", sql(f"SELECT {KEY}, suggested_budget_shift_pct FROM dec"))
def _(d):
    return decisions(d).select("hour_key", "sku", "suggested_budget_shift_pct")


@query("prj11_channel_shift", sql("SELECT channel, roas, suggested_budget_shift_pct FROM bud"))
def _(d):
    return gold.budget_shift(d.channel).select("channel", "roas", "suggested_budget_shift_pct")


@query("prj12_budget_action", sql("SELECT channel, budget_action FROM bud"))
def _(d):
    return gold.budget_shift(d.channel).select("channel", "budget_action")


@query("prj13_lift_projection", sql(
    "SELECT timestamp, category, avg_demand_spike_pct AS demand_lift_pct, avg_push_score, cvr_pct, "
    "roas FROM cat"))
def _(d):
    rows = gold.category_summary(d.marketing)
    return rows.select(
        "timestamp", "category", F.col("avg_demand_spike_pct").alias("demand_lift_pct"),
        "avg_push_score", "cvr_pct", "roas")


@query("prj14_harmonize_numbers", sql(
    "SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS unit_price, CAST(p_size AS BIGINT) AS size "
    "FROM part"))
def _(d):
    priced = d.raw("part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("p_size").cast("int").alias("size"))
    return harmonize_numbers(priced)


@query("prj17_top_by_rank", sql(
    "SELECT priority_rank, sku, push_score FROM rankd WHERE priority_rank <= 5"))
def _(d):
    return gold.prioritized(push(d)).filter(F.col("priority_rank") <= 5).select(
        "priority_rank", "sku", "push_score")


# --- joins ----------------------------------------------------------------


@query("jn01_kpi_stock_left", sql(
    "SELECT timestamp, hour_key, revenue_last_hour, stock_on_hand_total FROM kpis"))
def _(d):
    return gold.kpi_history(d.marketing, d.stock).select(
        "timestamp", "hour_key", "revenue_last_hour", "stock_on_hand_total")


@query("jn02_marketing_stock_left", sql(
    f"SELECT {KEY}, units_sold, closing_stock, stock_cover_hrs, stock_risk_flag FROM joined"))
def _(d):
    return gold.with_stock_and_product(d.marketing, d.stock, d.product).select(
        "hour_key", "sku", "units_sold", "closing_stock", "stock_cover_hrs", "stock_risk_flag")


@query("jn03_product_left", sql(f"SELECT {KEY}, margin_pct, unit_price, brand FROM joined"))
def _(d):
    return gold.with_stock_and_product(d.marketing, d.stock, d.product).select(
        "hour_key", "sku", "margin_pct", "unit_price", "brand")


@query("jn04_marketing_stock_inner", sql(
    "SELECT m.hour_key, m.sku, demand_index, closing_stock FROM mkt m JOIN stk s "
    "ON m.hour_key = s.hour_key AND m.sku = s.sku"))
def _(d):
    held = d.stock.select("hour_key", "sku", "closing_stock")
    return d.marketing.select("hour_key", "sku", "demand_index").join(held, ["hour_key", "sku"])


# --- aggregates -----------------------------------------------------------


@query("agg01_newest_time", sql("SELECT max(ts) AS newest FROM events"))
def _(d):
    return d.raw("events").agg(F.max("ts").alias("newest"))


@query("agg02_hourly_sums", sql(
    "SELECT timestamp, hour_key, revenue_last_hour, orders_last_hour, units_last_hour, "
    "sessions_last_hour FROM kpi"))
def _(d):
    return gold.hourly_kpis(d.marketing).select(
        "timestamp", "hour_key", "revenue_last_hour", "orders_last_hour", "units_last_hour",
        "sessions_last_hour")


@query("agg03_ratio_of_sums", sql(
    "SELECT hour_key, conversion_rate_pct, roas FROM kpi"))
def _(d):
    return gold.hourly_kpis(d.marketing).select("hour_key", "conversion_rate_pct", "roas")


@query("agg04_mean_demand", sql("SELECT hour_key, demand_pulse_index FROM kpi"))
def _(d):
    return gold.hourly_kpis(d.marketing).select("hour_key", "demand_pulse_index")


@query("agg05_stock_on_hand", sql("SELECT * FROM tot"))
def _(d):
    return gold.stock_totals(d.stock)


@query("agg06_mean_roas", sql(
    f"SELECT channel, roas, (SELECT {avg2('roas')} FROM chl) AS mean_roas FROM chl"))
def _(d):
    now = at_latest(d.channel)
    return now.select("channel", "roas", gold.mean_roas(now).alias("mean_roas"))


DEMAND_STOCK = (
    f"SELECT m.timestamp, {avg2('m.demand_index')} AS demand_index, "
    "CAST(SUM(s.closing_stock) AS BIGINT) AS stock_on_hand FROM mkt m JOIN stk s "
    "ON m.hour_key = s.hour_key AND m.sku = s.sku GROUP BY m.timestamp"
)


@query("agg07_demand_vs_stock", sql(DEMAND_STOCK))
def _(d):
    return gold.demand_vs_stock(d.marketing, d.stock)


@query("agg09_orders_summary", sql("SELECT * FROM ohs"))
def _(d):
    return gold.orders_summary(d.marketing)


@query("agg10_category_summary", sql("SELECT * FROM cat"))
def _(d):
    return gold.category_summary(d.marketing)


@query("agg13_percentiles", (
    "SELECT l_returnflag AS flag, quantile_cont(l_quantity, 0.5) AS p50, "
    "quantile_cont(l_quantity, 0.9) AS p90, quantile_cont(l_quantity, 0.95) AS p95 "
    "FROM lineitem GROUP BY 1"))
def _(d):
    lines = d.raw("lineitem").select(
        F.col("l_returnflag").alias("flag"), "l_quantity",
        # Equal quantities are told apart by the line they belong to.
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"))
    return percentiles(lines, "flag", "l_quantity", "line", {"p50": 0.5, "p90": 0.9, "p95": 0.95})


# --- windows --------------------------------------------------------------


@query("win01_priority_rank", sql("SELECT priority_rank, sku, push_score, roas, cvr_pct FROM rankd"))
def _(d):
    return gold.prioritized(push(d)).select("priority_rank", "sku", "push_score", "roas", "cvr_pct")


@query("win01_rank_per_hour", sql(
    "SELECT hour_key, sku, row_number() OVER (PARTITION BY hour_key ORDER BY push_score DESC, "
    "roas DESC, cvr_pct DESC, sku) AS priority_rank FROM mkt"))
def _(d):
    rows = d.marketing.select("hour_key", "sku", "push_score", "roas", "cvr_pct")
    return ranked(rows, gold.priority(), ["hour_key"]).select("hour_key", "sku", "priority_rank")


@query("win03_ledger_floor", sql("SELECT * FROM led_a"))
def _(d):
    return d.ledger("floor")


@query("win03_ledger_available", sql("SELECT * FROM led_b"))
def _(d):
    return d.ledger("sell_available")


@query("win04_opening_stock", sql("SELECT sku, timestamp, opening_stock FROM led_b"))
def _(d):
    return d.ledger().select("sku", "timestamp", "opening_stock")


@query("win05_channel_share", sql(
    f"SELECT timestamp, channel, {rnd('share', 9)} AS share FROM (SELECT timestamp, channel, "
    "revenue / SUM(revenue) OVER (PARTITION BY timestamp) AS share FROM chn)"))
def _(d):
    shares = share_of_total(d.channel, ["timestamp"], "revenue")
    return shares.select("timestamp", "channel", mt.rounded(F.col("share"), 9).alias("share"))


# --- dashboard ------------------------------------------------------------


@query("srt01_latest_kpi", sql("SELECT * FROM kpis ORDER BY timestamp DESC LIMIT 1"))
def _(d):
    return db.latest_kpi(gold.kpi_history(d.marketing, d.stock))


@query("srt02_demand_series", sql(DEMAND_STOCK + " ORDER BY m.timestamp"))
def _(d):
    return gold.demand_vs_stock(d.marketing, d.stock)


@query("srt03_category_lift", sql(
    "SELECT timestamp, category, avg_demand_spike_pct AS demand_lift_pct, avg_push_score, cvr_pct, "
    "roas FROM cat WHERE timestamp = (SELECT t FROM now_) ORDER BY demand_lift_pct DESC, category"))
def _(d):
    return db.lift_board(gold.category_lift(gold.category_summary(d.marketing), d.clock))


@query("srt04_push_board", sql(
    f"SELECT {', '.join(db.PUSH_COLUMNS)} FROM rankd ORDER BY priority_rank"))
def _(d):
    return db.push_board(gold.prioritized(push(d)))


@query("srt05_action_board", sql("SELECT * FROM acts ORDER BY priority_rank"))
def _(d):
    return db.action_board(gold.recommended_actions(push(d)))


def _drilldown(number: int, name: str) -> None:
    columns, lead = db.DRILLDOWNS[name]
    twin = sql(f"SELECT {', '.join(columns)} FROM push ORDER BY {lead} DESC, push_score DESC, sku")
    query(f"srt{number:02d}_drill_{name}", twin)(lambda d: db.drilldown(push(d), name))


for _number, _name in enumerate(db.DRILLDOWNS, start=6):
    _drilldown(_number, _name)


@query("srt11_drill_budget", sql("SELECT * FROM bud ORDER BY roas DESC, channel"))
def _(d):
    return db.budget_board(gold.budget_shift(d.channel))


@query("srt13_transaction_log", sql(
    "SELECT * FROM tx1 ORDER BY order_timestamp, sku, order_id"))
def _(d):
    return db.transaction_log(keep_newest(d.transactions, ["order_id"], ["shipped_at"]))


# --- metrics --------------------------------------------------------------


@query("met01_push_score", sql(f"SELECT {KEY}, push_score FROM mkt"))
def _(d):
    return d.marketing.select("hour_key", "sku", "push_score")


@query("met02_push_score_cover", sql(
    f"SELECT {KEY}, " + rnd(
        "0.27e0 * demand_spike_pct + 0.18e0 * roas * 10e0 + 0.18e0 * cvr_pct * 10e0 "
        "+ 0.17e0 * margin_pct + 0.10e0 * least(100e0, stock_cover_hrs / 24 * 100)", 1)
    + " AS push_score FROM joined"))
def _(d):
    c = F.col
    return gold.with_stock_and_product(d.marketing, d.stock, d.product).select(
        "hour_key", "sku",
        mt.push_score_by_cover(
            c("demand_spike_pct"), c("roas"), c("cvr_pct"), c("margin_pct"), c("stock_cover_hrs")
        ).alias("push_score"))


@query("met03_stock_cover", sql(f"SELECT {KEY}, stock_cover_hrs FROM stk"))
def _(d):
    return d.stock.select("hour_key", "sku", "stock_cover_hrs")


@query("met04_stock_risk", sql(
    "SELECT stock_risk_flag, COUNT(*) AS row_count FROM stk GROUP BY 1"))
def _(d):
    return d.stock.groupBy("stock_risk_flag").agg(F.count("*").alias("row_count"))


@query("met05_guarded_ratios", sql(
    "SELECT hour_key, sku, ctr_pct, cvr_pct, roas FROM mkt"))
def _(d):
    return d.marketing.select("hour_key", "sku", "ctr_pct", "cvr_pct", "roas")


@query("met05_channel_ratios", sql("SELECT hour_key, channel, cvr_pct, roas FROM chn"))
def _(d):
    return d.channel.select("hour_key", "channel", "cvr_pct", "roas")


@query("met06_order_value", sql(
    "SELECT sku, CAST(SUM(CAST(round(order_value * 100) AS BIGINT)) AS BIGINT) AS cents, "
    "COUNT(*) AS line_count FROM tx GROUP BY 1"))
def _(d):
    return d.transactions.groupBy("sku").agg(
        F.sum(units(F.col("order_value"))).alias("cents"), F.count("*").alias("line_count"))


@query("met07_demand_index", sql(f"SELECT {KEY}, demand_index FROM mkt"))
def _(d):
    return d.marketing.select("hour_key", "sku", "demand_index")


# --- whole builds ---------------------------------------------------------


@query("flow04_main_kpis", sql(
    "SELECT * FROM kpis WHERE timestamp = (SELECT t FROM now_)"))
def _(d):
    return gold.main_kpis(d.marketing, d.stock, clock=d.clock)


@query("flow04_kpi_history", sql("SELECT * FROM kpis"))
def _(d):
    return gold.kpi_history(d.marketing, d.stock)


@query("flow05_category_lift", sql(
    "SELECT timestamp, category, avg_demand_spike_pct AS demand_lift_pct, avg_push_score, cvr_pct, "
    "roas FROM cat WHERE timestamp = (SELECT t FROM now_)"))
def _(d):
    return gold.category_lift(gold.category_summary(d.marketing), d.clock)


@query("flow06_push_now", sql("SELECT * FROM rankd"))
def _(d):
    return gold.prioritized(push(d))


@query("flow06_push_history", sql("SELECT * FROM dec"))
def _(d):
    return decisions(d)


@query("flow07_action_centre", sql("SELECT * FROM acts"))
def _(d):
    return gold.recommended_actions(push(d))


@query("flow08_budget_shift", sql("SELECT * FROM bud"))
def _(d):
    return gold.budget_shift(d.channel)


@query("flow09_low_stock", sql(
    f"SELECT {', '.join(gold.LOW_STOCK_COLUMNS)} FROM push WHERE stock_cover_hrs < 12"))
def _(d):
    return gold.low_stock(push(d))


