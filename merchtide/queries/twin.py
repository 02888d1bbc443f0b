"""SQL building blocks of the twins: the test-data mapping as common table expressions."""

from __future__ import annotations

from merchtide import model
from merchtide.sources.testdata import BATCH_PROCESSES, EVENT_PROCESSES


def rnd(expression: str, digits: int) -> str:
    """Half-to-even rounding on the scaled value."""
    scale = f"1e{digits}"
    return f"(round_even(({expression}) * {scale}, 0) / {scale})"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def avg2(column: str) -> str:
    """Mean of a value with two decimals, summed in whole units."""
    return (
        f"CAST(SUM(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / (COUNT({column}) * 100e0)"
    )


def sum2(column: str) -> str:
    return f"CAST(SUM(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / 100e0"


def minutes(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 6e7)"


def plus_minutes(ts: str, value: str) -> str:
    return f"({ts} + to_microseconds(CAST(round_even(({value}) * 6e7, 0) AS BIGINT)))"


SEPARATORS = (
    r"[,._\-\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}"
    r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def token_list(column: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({column}), '{SEPARATORS}'), lambda x: x <> '')"


SLOT = "CAST(('0x' || substr(md5(t), 1, 8))::BIGINT % 32 AS INTEGER)"
SIGN = "CASE WHEN ('0x' || substr(md5(t), 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END"


def assumed(field: str) -> str:
    """The history value that the name of batch ``i`` stands for."""
    when = " ".join(
        f"WHEN contains(i.batch_id, {text(part)}) THEN {getattr(record, field)}"
        for part, record in model.ASSUMED_HISTORY.items())
    return f"CASE {when} END"


def vectors(name: str, source: str, key: str, column: str) -> dict[str, str]:
    """CTEs that end in ``name`` (key, i, c, v): counts and unit values per position."""
    return {
        f"{name}_tok": f"SELECT {key}, unnest({token_list(column)}) AS t FROM {source}",
        f"{name}_sum": f"SELECT {key}, {SLOT} AS i, SUM({SIGN}) AS c FROM {name}_tok GROUP BY 1, 2",
        f"{name}_norm": f"SELECT {key}, sqrt(CAST(SUM(c * c) AS DOUBLE)) AS n "
                        f"FROM {name}_sum GROUP BY 1",
        name: f"SELECT b.{key}, r.i AS i, CAST(coalesce(s.c, 0) AS BIGINT) AS c, "
              f"CASE WHEN coalesce(n.n, 0) = 0 THEN 0e0 "
              f"ELSE {rnd('coalesce(s.c, 0) / n.n', 6)} END AS v "
              f"FROM {source} b CROSS JOIN (SELECT CAST(unnest(range(32)) AS INTEGER) AS i) r "
              f"LEFT JOIN {name}_sum s ON s.{key} = b.{key} AND s.i = r.i "
              f"LEFT JOIN {name}_norm n ON n.{key} = b.{key}",
    }


def _case(subject: str, values) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {text(v) if isinstance(v, str) else 'NULL' if v is None else texts(v)}"
        for i, v in enumerate(values)
    )
    return f"CASE {subject} {whens} END"


def percentile(listed: str, p: float) -> str:
    """Linear percentile of a sorted list."""
    spot = f"((len({listed}) - 1) * {p}::DOUBLE)"
    low = f"{listed}[CAST(floor({spot}) AS BIGINT) + 1]"
    high = f"{listed}[CAST(ceil({spot}) AS BIGINT) + 1]"
    return f"({low} + ({high} - {low}) * ({spot} - floor({spot})))"


HEALTH_DEFAULTS = ", ".join(
    f"({text(p)}, 'HEALTHY', 0e0, {text(r)}, {text(f'No delay reported for {p}.')})"
    for p, r in model.PROCESS_RESOURCES.items()
)
KB_ROWS = ", ".join(
    "("
    + ", ".join(
        [
            text(e.kb_id), text(e.process), text(e.resource),
            text(" ".join([e.process, e.resource, *e.symptoms, *e.likely_root_causes,
                           *e.mitigations, *e.resources_to_check])),
            texts(e.mitigations), texts(e.likely_root_causes), text(e.escalation_team),
            texts(e.resources_to_check),
        ]
    )
    + ")"
    for e in model.STARTER_KNOWLEDGE
)

CTES: dict[str, str] = {
    "ev": "SELECT event_id, ts, date_trunc('day', ts) AS timestamp, user_id, event_type, value, "
          "CAST(round(value * 100) AS BIGINT) AS cents FROM events",
    "product": "SELECT concat('P', p_partkey) AS sku, p_name AS product_name, p_type AS category, "
               "p_brand AS brand, p_retailprice AS unit_price, "
               "CAST(20 + p_size AS DOUBLE) AS margin_pct, "
               "CAST((4 + p_partkey % 37) * 4 AS INTEGER) AS base_stock, "
               "CAST(6 + p_size % 25 AS DOUBLE) AS initial_stock_cover_hrs FROM part",
    "act": "SELECT timestamp, concat('P', user_id) AS sku, CAST(count(*) * 10 AS BIGINT) AS sessions, "
           "CAST(count_if(event_type = 'click') AS BIGINT) AS clicks, "
           "CAST(count_if(event_type = 'purchase') AS BIGINT) AS orders, "
           "CAST(count_if(event_type = 'signup') AS BIGINT) AS signups, "
           "CAST(2 * count_if(event_type = 'purchase') + count_if(event_type = 'signup') AS BIGINT) "
           "AS units_sold, "
           "CAST(SUM(CASE WHEN event_type = 'purchase' THEN cents ELSE 0 END) AS DOUBLE) / 100e0 "
           "AS gross_revenue, "
           "CAST(SUM(CASE WHEN event_type = 'click' THEN cents ELSE 0 END) AS DOUBLE) / 100e0 "
           "AS ad_spend FROM ev GROUP BY timestamp, user_id",
    "slot": "SELECT dayofweek(timestamp) AS slot, CAST(SUM(units_sold) AS DOUBLE) / COUNT(*) AS usual "
            "FROM act GROUP BY 1",
    "mk0": "SELECT a.timestamp, strftime(a.timestamp, '%Y%m%d%H') AS hour_key, a.sku, a.sessions, "
           f"a.clicks, {rnd('a.clicks / a.sessions * 100', 2)} AS ctr_pct, a.orders, a.units_sold, "
           f"{rnd('a.orders / a.sessions * 100', 2)} AS cvr_pct, a.gross_revenue, a.ad_spend, "
           f"{rnd('coalesce(a.gross_revenue / nullif(a.ad_spend, 0), 0e0)', 2)} AS roas, "
           f"{rnd('a.units_sold / nullif(s.usual, 0) * 100', 2)} AS demand_index, "
           "CAST(least(12, a.signups * 1.5) AS DOUBLE) AS discount_pct, "
           "40 + a.sessions % 50 AS avg_dwell_time_sec "
           "FROM act a JOIN slot s ON dayofweek(a.timestamp) = s.slot",
    "mk1": f"SELECT *, {rnd('greatest(0e0, demand_index - 100e0)', 1)} AS demand_spike_pct FROM mk0",
    "mkt": "SELECT m.timestamp, m.hour_key, m.sku, p.product_name, p.category, m.sessions, m.clicks, "
           "m.ctr_pct, m.orders, m.units_sold, m.cvr_pct, m.gross_revenue, m.ad_spend, m.roas, "
           "m.demand_index, m.demand_spike_pct, m.discount_pct, m.avg_dwell_time_sec, "
           + rnd("0.27e0 * demand_spike_pct + 0.18e0 * roas * 10e0 + 0.18e0 * cvr_pct * 10e0 "
                 "+ 0.17e0 * p.margin_pct + 0.10e0 * least(100e0, ctr_pct * 12e0)", 1)
           + " AS push_score FROM mk1 m JOIN product p ON m.sku = p.sku",
    "mv": "SELECT a.timestamp, a.sku, a.units_sold AS u, CASE WHEN signups > 0 THEN 6 ELSE 0 END AS r, "
          "p.base_stock AS base FROM act a JOIN product p ON a.sku = p.sku",
    "lb0": "SELECT *, coalesce(lag(r) OVER (PARTITION BY sku ORDER BY timestamp), 0) - u AS step FROM mv",
    "lb1": "SELECT *, base + SUM(step) OVER (PARTITION BY sku ORDER BY timestamp) AS walk FROM lb0",
    "lb2": "SELECT *, walk - least(0, MIN(walk) OVER (PARTITION BY sku ORDER BY timestamp)) + r AS closing "
           "FROM lb1",
    "lb3": "SELECT *, coalesce(lag(closing) OVER (PARTITION BY sku ORDER BY timestamp), base) AS opening "
           "FROM lb2",
    "led_b": "SELECT sku, timestamp, CAST(opening AS BIGINT) AS opening_stock, "
             "CAST(least(u, opening) AS BIGINT) AS units_sold, CAST(r AS BIGINT) AS restocked_units, "
             "CAST(closing AS BIGINT) AS closing_stock FROM lb3",
    "la1": "SELECT *, base + SUM(r - u) OVER (PARTITION BY sku ORDER BY timestamp) AS walk FROM mv",
    "la2": "SELECT *, walk - least(0, MIN(walk) OVER (PARTITION BY sku ORDER BY timestamp)) AS closing "
           "FROM la1",
    "led_a": "SELECT sku, timestamp, "
             "CAST(coalesce(lag(closing) OVER (PARTITION BY sku ORDER BY timestamp), base) AS BIGINT) "
             "AS opening_stock, CAST(u AS BIGINT) AS units_sold, CAST(r AS BIGINT) AS restocked_units, "
             "CAST(closing AS BIGINT) AS closing_stock FROM la2",
    "st0": f"SELECT *, {rnd('closing_stock / greatest(units_sold, 1)', 1)} AS stock_cover_hrs FROM led_b",
    "stk": "SELECT s.timestamp, strftime(s.timestamp, '%Y%m%d%H') AS hour_key, s.sku, p.product_name, "
           "p.category, s.opening_stock, s.units_sold, s.restocked_units, s.closing_stock, "
           "s.stock_cover_hrs, CASE WHEN stock_cover_hrs < 12 THEN 'High' "
           "WHEN stock_cover_hrs < 18 THEN 'Medium' ELSE 'Low' END AS stock_risk_flag "
           "FROM st0 s JOIN product p ON s.sku = p.sku",
    "now_": "SELECT date_trunc('day', max(ts)) AS t FROM events",
    "kpi": "SELECT timestamp, hour_key, " + sum2("gross_revenue") + " AS revenue_last_hour, "
           "CAST(SUM(orders) AS BIGINT) AS orders_last_hour, "
           "CAST(SUM(units_sold) AS BIGINT) AS units_last_hour, "
           "CAST(SUM(sessions) AS BIGINT) AS sessions_last_hour, "
           "CAST(SUM(orders) AS DOUBLE) / nullif(SUM(sessions), 0) * 100 AS conversion_rate_pct, "
           + sum2("gross_revenue") + " / nullif(" + sum2("ad_spend") + ", 0) AS roas, "
           + avg2("demand_index") + " AS demand_pulse_index FROM mkt GROUP BY 1, 2",
    "tot": "SELECT timestamp, CAST(SUM(closing_stock) AS BIGINT) AS stock_on_hand_total FROM stk GROUP BY 1",
    "kpis": "SELECT k.timestamp, hour_key, revenue_last_hour, orders_last_hour, units_last_hour, "
            "sessions_last_hour, conversion_rate_pct, roas, stock_on_hand_total, demand_pulse_index "
            "FROM kpi k LEFT JOIN tot t ON k.timestamp = t.timestamp",
    "cat": "SELECT *, " + rnd("orders / nullif(sessions, 0) * 100", 2) + " AS cvr_pct, "
           + rnd("revenue / nullif(ad_spend, 0)", 2) + " AS roas FROM (SELECT timestamp, hour_key, "
           "category, CAST(SUM(sessions) AS BIGINT) AS sessions, CAST(SUM(orders) AS BIGINT) AS orders, "
           + sum2("gross_revenue") + " AS revenue, " + sum2("ad_spend") + " AS ad_spend, "
           + rnd(avg2("demand_spike_pct"), 1) + " AS avg_demand_spike_pct, "
           + rnd(avg2("push_score"), 1) + " AS avg_push_score FROM mkt GROUP BY 1, 2, 3)",
    "ohs": "SELECT *, " + rnd("total_orders / nullif(total_sessions, 0) * 100", 2)
           + " AS conversion_rate_pct, " + rnd("revenue / nullif(total_orders, 0)", 2) + " AS aov FROM "
           "(SELECT timestamp, hour_key, CAST(SUM(orders) AS BIGINT) AS total_orders, "
           "CAST(SUM(units_sold) AS BIGINT) AS total_units, "
           "CAST(SUM(sessions) AS BIGINT) AS total_sessions, " + sum2("gross_revenue") + " AS revenue, "
           + sum2("ad_spend") + " AS ad_spend FROM mkt GROUP BY 1, 2)",
    "joined": "SELECT m.*, s.closing_stock, s.stock_cover_hrs, s.stock_risk_flag, p.margin_pct, "
              "p.unit_price, p.brand FROM mkt m LEFT JOIN stk s ON m.hour_key = s.hour_key "
              "AND m.sku = s.sku LEFT JOIN product p ON m.sku = p.sku",
    "de0": "SELECT *, CASE WHEN stock_cover_hrs < 12 THEN 'PROMOTE_CAREFULLY_LOW_STOCK' "
           "WHEN roas >= 5 AND cvr_pct >= 4.5 THEN 'PUSH_NOW_PAID_AND_OWNED' "
           "WHEN margin_pct >= 45 THEN 'PUSH_HIGH_INTENT_PROFIT' ELSE 'SECONDARY_PUSH' END AS decision "
           "FROM joined",
    "de1": "SELECT *, CASE decision WHEN 'PUSH_NOW_PAID_AND_OWNED' THEN 'Push Now' "
           "WHEN 'PROMOTE_CAREFULLY_LOW_STOCK' THEN 'Guarded Push' ELSE 'Secondary Push' END "
           "AS action_type FROM de0",
    "dec": "SELECT *, CASE action_type "
           + " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in model.CHANNEL_SEQUENCES.items())
           + " END AS primary_channel_sequence, CASE action_type WHEN 'Push Now' THEN 12e0 "
           "WHEN 'Secondary Push' THEN 5e0 ELSE 0e0 END AS suggested_budget_shift_pct FROM de1",
    "push": "SELECT * FROM dec WHERE timestamp = (SELECT t FROM now_)",
    "rankd": "SELECT *, row_number() OVER (ORDER BY push_score DESC, roas DESC, cvr_pct DESC, sku) "
             "AS priority_rank FROM push",
    "acts": "SELECT priority_rank, sku, product_name, category, action_type, "
            "primary_channel_sequence, concat('Demand spike ', CAST(demand_spike_pct AS VARCHAR), "
            "'%, CVR ', CAST(cvr_pct AS VARCHAR), '%, ROAS ', CAST(roas AS VARCHAR), "
            "'x, stock cover ', CAST(stock_cover_hrs AS VARCHAR), ' hrs') AS reason, "
            "suggested_budget_shift_pct, timestamp + INTERVAL 3 HOUR AS keep_promoting_until_hour "
            "FROM rankd WHERE priority_rank <= 5",
    "chn": "SELECT timestamp, strftime(timestamp, '%Y%m%d%H') AS hour_key, channel, sessions, orders, "
           "revenue, ad_spend, " + rnd("orders / greatest(CAST(sessions AS DOUBLE), 1e0) * 100", 2)
           + " AS cvr_pct, " + rnd("revenue / greatest(ad_spend, 1e0)", 2) + " AS roas FROM "
           "(SELECT date_trunc('quarter', o_orderdate) AS timestamp, o_orderpriority AS channel, "
           "CAST(COUNT(*) * 20 AS BIGINT) AS sessions, COUNT(*) AS orders, "
           + sum2("o_totalprice") + " AS revenue, "
           "CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) "
           "ELSE 0 END) AS DOUBLE) / 100e0 AS ad_spend FROM orders GROUP BY 1, 2)",
    "chl": "SELECT * FROM chn WHERE timestamp = (SELECT max(timestamp) FROM chn)",
    "bud0": "SELECT *, CASE WHEN roas >= (SELECT " + avg2("roas") + " FROM chl) * 1.15e0 THEN 12e0 "
            "WHEN roas >= (SELECT " + avg2("roas") + " FROM chl) THEN 5e0 ELSE -8e0 END "
            "AS suggested_budget_shift_pct FROM chl",
    "bud": "SELECT *, CASE WHEN suggested_budget_shift_pct > 0 THEN 'Increase' ELSE 'Reduce' END "
           "AS budget_action FROM bud0",
    "tx": "SELECT concat(l_orderkey, '-', l_linenumber) AS order_id, o_orderdate AS order_timestamp, "
          "concat('P', l_partkey) AS sku, p_name AS product_name, p_type AS category, "
          "CAST(l_quantity AS INTEGER) AS quantity, "
          + rnd("p_retailprice * l_quantity * (1e0 - " + rnd("l_discount * 100", 1) + " / 100)", 2)
          + " AS order_value, " + rnd("l_discount * 100", 1) + " AS discount_pct, "
          "o_orderpriority AS traffic_channel, n_name AS city, c_mktsegment AS customer_type, "
          "l_returnflag AS payment_mode, l_shipdate AS shipped_at, l_linestatus AS line_status "
          "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey "
          "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    # The newest line per order id: last shipped, then greatest by value.
    "tx1": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
           "ORDER BY shipped_at DESC, order_timestamp DESC, sku DESC, product_name DESC, category DESC, "
           "quantity DESC, order_value DESC, discount_pct DESC, traffic_channel DESC, city DESC, "
           "customer_type DESC, payment_mode DESC, line_status DESC) AS rn FROM tx) WHERE rn = 1",
    # The same, where open lines (a later batch) replace finished ones.
    "tx2": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
           "ORDER BY line_status DESC, shipped_at DESC, order_timestamp DESC, sku DESC, "
           "product_name DESC, category DESC, quantity DESC, order_value DESC, discount_pct DESC, "
           "traffic_channel DESC, city DESC, customer_type DESC, payment_mode DESC) AS rn FROM tx) "
           "WHERE rn = 1",
    "rst": "SELECT sku, product_name, TIMESTAMP '2024-02-01 00:00:00' + "
           "to_days(CAST(CAST(substr(sku, 2) AS BIGINT) % 30 AS INTEGER)) "
           "AS scheduled_restock_timestamp, CAST(base_stock * 10 AS BIGINT) AS restock_units, "
           "'Planned' AS status FROM product",
    # --- batch risk ---
    "reg": "SELECT concat('B', c_custkey) AS batch_id, c_mktsegment AS business_domain, "
           "CASE WHEN c_acctbal >= 5000 THEN 'HIGH' ELSE 'MEDIUM' END AS criticality, "
           "CAST(c_custkey % 15 AS BIGINT) AS expected_data_available_minute, "
           "CAST(40 + c_custkey % 30 AS BIGINT) AS sla_offset_minutes, "
           "concat('Team ', c_nationkey) AS owner_team, "
           "CASE WHEN c_acctbal < 0 THEN false WHEN c_nationkey <> 7 THEN true END AS active_flag, "
           + _case("c_custkey % 3", BATCH_PROCESSES) + " AS processes FROM customer",
    "rte": "SELECT event_id, concat('B', user_id) AS batch_id, ts AS event_time, "
           "date_trunc('hour', ts) AS actual_start_time, "
           + _case("event_id % 10", EVENT_PROCESSES) + " AS current_process, "
           "concat('node_', event_type) AS current_resource, "
           "CASE WHEN event_type = 'error' THEN 'DEGRADED' WHEN event_type <> 'view' THEN 'HEALTHY' END "
           "AS process_status, value / 25e0 AS process_delay_min, "
           "concat_ws(' ', " + _case("event_id % 10", EVENT_PROCESSES)
           + ", 'reported', event_type) AS message FROM events",
    "clk": "SELECT date_trunc('hour', max(ts)) + INTERVAL 30 MINUTE AS n FROM events",
    "inp": "SELECT r.*, n AS prediction_time, "
           "date_trunc('hour', n) + to_minutes(expected_data_available_minute) AS data_available_time, "
           "date_trunc('hour', n) + to_minutes(sla_offset_minutes) AS sla_due_time, "
           "date_trunc('hour', n) + to_minutes(expected_data_available_minute + 4) "
           "AS actual_start_time FROM reg r, clk WHERE coalesce(active_flag, true)",
    "obs": "SELECT current_process AS process, coalesce(process_status, 'UNKNOWN') AS status, "
           "coalesce(process_delay_min, 0) AS delay_min, current_resource AS resource, message FROM "
           "(SELECT *, row_number() OVER (PARTITION BY current_process ORDER BY event_id DESC) AS rn "
           "FROM rte WHERE date_trunc('hour', event_time) = (SELECT date_trunc('hour', max(ts)) FROM events) "
           "AND current_process IS NOT NULL) WHERE rn = 1",
    "hlt": "SELECT * FROM obs UNION ALL SELECT * FROM (VALUES " + HEALTH_DEFAULTS
           + ") d(process, status, delay_min, resource, message) "
           "WHERE process NOT IN (SELECT process FROM obs)",
    "run0": "SELECT batch_id, actual_start_time, max(event_time) AS ended_at FROM rte GROUP BY 1, 2",
    "run": "SELECT n.batch_id, actual_start_time, "
           "epoch_us(ended_at) - epoch_us(actual_start_time) AS us, "
           "coalesce(ended_at > actual_start_time + to_minutes(r.sla_offset_minutes), false) AS missed "
           "FROM run0 n LEFT JOIN reg r ON n.batch_id = r.batch_id",
    "his0": "SELECT batch_id, COUNT(*) AS run_count, CAST(SUM(us) AS DOUBLE) / COUNT(*) AS mean_us, "
            "count_if(missed) AS missed, count_if(missed AND actual_start_time >= "
            "(SELECT n FROM clk) - INTERVAL 30 DAY) AS recent, list(us ORDER BY us) AS l "
            "FROM run GROUP BY 1",
    "his": "SELECT batch_id, run_count, mean_us / 6e7 AS avg_duration_min, "
           + percentile("l", 0.9) + " / 6e7 AS p90_duration_min, "
           + percentile("l", 0.95) + " / 6e7 AS p95_duration_min, "
           "CAST(run_count - missed AS DOUBLE) / run_count * 100 AS historical_success_rate_pct, "
           "CAST(recent AS BIGINT) AS historical_sla_miss_count_30d FROM his0",
    "wh": "SELECT i.*, coalesce(h.avg_duration_min, 30e0) AS avg_duration_min, "
          "coalesce(h.p90_duration_min, 40e0) AS p90_duration_min, "
          "coalesce(h.p95_duration_min, 45e0) AS p95_duration_min, "
          "coalesce(h.historical_success_rate_pct, 95e0) AS historical_success_rate_pct, "
          "coalesce(h.historical_sla_miss_count_30d, 0) AS historical_sla_miss_count_30d "
          "FROM inp i LEFT JOIN his h ON i.batch_id = h.batch_id",
    "wha": "SELECT i.*, coalesce(h.avg_duration_min, "
           + assumed("avg") + ") AS avg_duration_min, coalesce(h.p90_duration_min, "
           + assumed("p90") + ") AS p90_duration_min, coalesce(h.p95_duration_min, "
           + assumed("p95") + ") AS p95_duration_min, coalesce(h.historical_success_rate_pct, "
           + assumed("success") + ") AS historical_success_rate_pct, "
           "coalesce(h.historical_sla_miss_count_30d, " + assumed("misses")
           + ") AS historical_sla_miss_count_30d "
           "FROM inp i LEFT JOIN his h ON i.batch_id = h.batch_id",
    "stp": "SELECT batch_id, unnest(processes) AS process, generate_subscripts(processes, 1) AS pos "
           "FROM inp",
    "stph": "SELECT s.batch_id, s.pos, s.process, coalesce(h.status, 'UNKNOWN') AS status, "
            "coalesce(h.delay_min, 0) AS delay_min, h.resource, h.message "
            "FROM stp s LEFT JOIN hlt h ON s.process = h.process",
    "dly": "SELECT batch_id, CAST(SUM(CAST(round(delay_min * 1e6) AS BIGINT)) AS DOUBLE) / 1e6 "
           "AS resource_delay_min, coalesce(string_agg(process, ',' ORDER BY pos) "
           "FILTER (WHERE status <> 'HEALTHY'), '') AS degraded, "
           "coalesce(string_agg(concat_ws(' ', process, resource, message), ' ' ORDER BY pos) "
           "FILTER (WHERE status <> 'HEALTHY'), '') AS trouble, coalesce(string_agg(concat_ws(';', process, "
           "status, CAST(CAST(round(delay_min * 1e6) AS BIGINT) AS VARCHAR), resource, message), chr(10) "
           "ORDER BY pos) FILTER (WHERE status <> 'HEALTHY'), '') AS late_steps FROM stph GROUP BY 1",
    "tim": "SELECT w.*, d.resource_delay_min, d.degraded, d.trouble, d.late_steps, "
           + minutes("data_available_time", "prediction_time") + " AS since_data, "
           + minutes("actual_start_time", "prediction_time") + " AS since_start, "
           + minutes("prediction_time", "sla_due_time") + " AS remaining "
           "FROM wha w JOIN dly d ON w.batch_id = d.batch_id",
    "ttl": "SELECT *, p95_duration_min + resource_delay_min + greatest(0e0, since_start - avg_duration_min) "
           "AS total FROM tim",
    "eta": "SELECT *, " + plus_minutes("actual_start_time", "total") + " AS eta FROM ttl",
    "sc": "SELECT *, eta > sla_due_time AS will_miss_sla, greatest(0e0, "
          + minutes("sla_due_time", "eta") + ") AS late, "
          "least(100, CASE WHEN eta > sla_due_time THEN 45 ELSE 0 END "
          "+ CASE WHEN remaining < p95_duration_min THEN 20 ELSE 0 END "
          "+ CASE WHEN resource_delay_min >= 10 THEN 15 ELSE 0 END "
          "+ CASE WHEN historical_sla_miss_count_30d >= 3 THEN 10 ELSE 0 END "
          "+ CASE WHEN criticality = 'HIGH' THEN 10 ELSE 0 END) AS risk_score FROM eta",
    "prd": "SELECT *, CASE WHEN risk_score >= 75 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH' "
           "WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level, "
           + rnd("late", 2) + " AS estimated_minutes_late FROM sc",
    "trg": "SELECT * FROM prd WHERE will_miss_sla OR risk_level IN ('HIGH', 'CRITICAL')",
    "kb": "SELECT * FROM (VALUES " + KB_ROWS + ") k(kb_id, process, resource, text_blob, mitigations, "
          "causes, team, checks)",
    **vectors("kbv", "kb", "kb_id", "text_blob"),
    "qry": "SELECT batch_id, concat_ws(' ', batch_id, risk_level, array_to_string(processes, ' '), "
           "trouble) AS q FROM trg",
    **vectors("qv", "qry", "batch_id", "q"),
    "sim": "SELECT q.batch_id, k.kb_id, SUM(q.v * k.v) AS likeness FROM qv q JOIN kbv k ON q.i = k.i "
           "GROUP BY 1, 2",
    "mtc0": "SELECT s.batch_id, s.kb_id, " + rnd(
        "likeness + len(list_filter(t.processes, lambda p: p = k.process)) * 0.25e0 "
        "+ len(list_filter(string_split(t.degraded, ','), lambda p: p = k.process)) * 0.40e0", 4)
            + " AS score, k.process, k.mitigations, t.risk_level, t.estimated_minutes_late "
            "FROM sim s JOIN kb k ON s.kb_id = k.kb_id JOIN trg t ON s.batch_id = t.batch_id",
    "mtc": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY score DESC, kb_id) "
           "AS place FROM mtc0) WHERE place <= 3",
    **vectors("dv", "documents", "doc_id", "text"),
    **vectors("bv", "benchmark", "item_id", "text"),
    "dbs": "SELECT d.doc_id, b.item_id, " + rnd("SUM(d.v * b.v)", 4) + " AS score "
           "FROM dv d JOIN bv b ON d.i = b.i GROUP BY 1, 2",
    "cv0": "SELECT concat(conv_id, '-', turn) AS turn_id, max(coalesce(text, '')) AS text "
           "FROM conversations GROUP BY 1",
    **vectors("cv", "cv0", "turn_id", "text"),
    "cbs": "SELECT d.doc_id, c.turn_id, " + rnd("SUM(d.v * c.v)", 4) + " AS score "
           "FROM dv d JOIN cv c ON d.i = c.i GROUP BY 1, 2",
}


def sql(body: str) -> str:
    """The body with every CTE it names, directly or not."""
    needed: set[str] = set()

    def visit(fragment: str) -> None:
        words = set(fragment.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    listed = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {listed} {body}" if listed else body
