"""The risk estimate worked out by hand, and the run around it."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merchtide import model
from merchtide.plans import sla
from merchtide.sources import tables

NOW = datetime(2024, 5, 1, 10, 30)
REGISTRY = [
    ("PRODUCT_MASTER", "MEDIUM", 5, 45, ["raw_file_arrival", "bronze_ingestion"]),
    ("MARKETING_PERFORMANCE", "HIGH", 10, 60, ["campaign_metrics_join"]),
    ("STOCK_MOVEMENT", "HIGH", 8, 60, ["stock_reconciliation"]),
    ("ORDERS_HOURLY", "HIGH", 6, 60, ["gold_aggregation"]),
    ("CATEGORY_PERFORMANCE", "MEDIUM", 12, 65, ["dashboard_refresh"]),
]
# eta minute, minutes late, score, level, triggered
GOLDEN = {
    "PRODUCT_MASTER": (47, 2.0, 65, "HIGH", True),
    "MARKETING_PERFORMANCE": (49, 0.0, 30, "MEDIUM", False),
    "STOCK_MOVEMENT": (66, 6.0, 85, "CRITICAL", True),
    "ORDERS_HOURLY": (52, 0.0, 30, "MEDIUM", False),
    "CATEGORY_PERFORMANCE": (54, 0.0, 20, "LOW", False),
}


@pytest.fixture()
def registry(spark):
    rows = [(b, "Shop", c, a, s, "Team", "Team", None, p) for b, c, a, s, p in REGISTRY]
    rows.append(("SWITCHED_OFF", "Shop", "HIGH", 0, 1, "Team", "Team", False, []))
    return spark.createDataFrame(rows, model.BATCH_REGISTRY_DDL)


@pytest.fixture()
def no_events(spark):
    return spark.createDataFrame([], model.RUNTIME_EVENT_DDL)


def clock():
    return F.lit(NOW).cast("timestamp_ntz")


def test_golden_run(spark, registry):
    found = sla.predictions(
        sla.batch_inputs(registry, clock()), sla.assumed_history(registry),
        sla.default_health(spark))
    fired = {r.batch_id for r in sla.triggered(found).collect()}
    got = {
        r.batch_id: (
            (r.estimated_completion_time - NOW.replace(minute=0)).total_seconds() / 60,
            r.estimated_minutes_late, r.risk_score, r.risk_level, r.batch_id in fired)
        for r in found.collect()
    }
    assert got == GOLDEN
    assert sla.run_summary(found).first().asDict() == {
        "batches_checked": 5, "agent_trigger_count": 2}


def test_unknown_batch_gets_the_whole_default(spark, registry, no_events):
    inputs = sla.batch_inputs(registry, clock())
    rows = sla.with_history(inputs, sla.duration_history(no_events, registry)).collect()
    assert {(r.avg_duration_min, r.p90_duration_min, r.p95_duration_min,
             r.historical_success_rate_pct, r.historical_sla_miss_count_30d) for r in rows} == {
        (30.0, 40.0, 45.0, 95.0, 0)}


def test_observed_history_goes_before_assumed_and_default(spark, registry, no_events):
    own = spark.createDataFrame(
        [("STOCK_MOVEMENT", 1, 1.0, 2.0, 3.0, 50.0, 7)],
        sla.duration_history(no_events, registry).schema)
    named = {k: v for k, v in model.ASSUMED_HISTORY.items() if k}
    inputs = sla.batch_inputs(registry, clock())
    rows = {r.batch_id: r for r in sla.with_history(inputs, own, named).collect()}
    assert len(rows) == inputs.count()
    for name, row in rows.items():
        rules = [v for k, v in named.items() if k in name]
        record = rules[0] if rules else model.UNKNOWN_HISTORY
        expected = (3.0, 7) if name == "STOCK_MOVEMENT" else (record.p95, record.misses)
        assert (row.p95_duration_min, row.historical_sla_miss_count_30d) == expected


def test_delay_of_processes(spark):
    health = spark.createDataFrame(
        [("a", "HEALTHY", 1.5, "ra", "ma"), ("b", "DEGRADED", 8.25, "rb", "mb"),
         ("b", "LATE", 2.0, "rc", "mc")], sla.HEALTH_DDL)
    inputs = spark.createDataFrame(
        [("B1", ["b", "a", "zz"]), ("B2", ["a"]), ("B3", [])], "batch_id string, processes array<string>")
    rows = sla.with_process_delay(inputs, health).collect()
    assert {
        r.batch_id: (r.resource_delay_min, [tuple(d) for d in r.degraded_processes]) for r in rows
    } == {
        "B1": (9.75, [("b", "DEGRADED", 8.25, "rb", "mb"), ("zz", "UNKNOWN", 0.0, None, None)]),
        "B2": (1.5, []), "B3": (0.0, []),
    }


def test_newest_event_speaks_for_its_process(spark):
    at = datetime(2024, 1, 1)
    old = datetime(2023, 1, 1)
    rows = [
        ("1", at, "a", "LATE", 3.0), ("2", at, "a", None, None), ("3", old, "b", "LATE", 9.0),
        ("4", at, None, "LATE", 1.0), ("5", at, "", "LATE", 1.0),
    ]
    events = spark.createDataFrame(
        rows, "event_id string, event_time timestamp, current_process string, "
              "process_status string, process_delay_min double"
    ).withColumns({"current_resource": F.lit("r"), "message": F.lit("m")})
    got = [tuple(r) for r in sla.latest_health(events).collect()]
    assert got == [("a", "UNKNOWN", 0.0, "r", "m")]
    whole = {r.process: r.status for r in sla.process_health(events).collect()}
    assert whole == {**{p: "HEALTHY" for p in model.PROCESS_RESOURCES}, "a": "UNKNOWN"}


def test_monitor_writes_and_repeats_ids(spark, registry, tmp_path):
    # Two runs of the stock batch: 50 and 70 minutes, the second one late.
    starts = [datetime(2024, 4, 30, 8, 0), datetime(2024, 4, 30, 9, 0)]
    rows = [
        (str(i), "STOCK_MOVEMENT", end, None, start, "RUNNING", "stock_reconciliation", "feed",
         "DEGRADED", 12.0, "slow", None)
        for i, (start, end) in enumerate(zip(
            starts, [datetime(2024, 4, 30, 8, 50), datetime(2024, 4, 30, 10, 10)]))
    ]
    events = spark.createDataFrame(rows, model.RUNTIME_EVENT_DDL)
    history = sla.duration_history(events, registry, clock()).first()
    assert (history.avg_duration_min, history.p90_duration_min, history.p95_duration_min) == (
        pytest.approx((60.0, 68.0, 69.0)))
    assert (history.historical_success_rate_pct, history.historical_sla_miss_count_30d) == (50.0, 1)
    ops = str(tmp_path)
    knowledge = sla.starter_knowledge(spark)
    first = sla.run_monitor(spark, ops, registry, events, knowledge, NOW)
    assert first == sla.run_monitor(spark, ops, registry, events, knowledge, NOW)
    assert first["batches_checked"] == 5
    predictions = spark.read.parquet(f"{ops}/sla_prediction_results")
    assert predictions.count() == 10
    assert predictions.select("prediction_id").distinct().count() == 5
    advice = spark.read.parquet(f"{ops}/sla_agent_recommendations")
    stock = advice.filter("batch_id = 'STOCK_MOVEMENT'").first()
    assert stock.next_best_actions[:3] == [
        model.NOTIFY_ACTION, model.PRIORITIZE_ACTION,
        "stock_reconciliation: replay the missing stock hours"]
    assert tables.read_table(spark, f"{ops}/sla_batch_registry").count() == 6
