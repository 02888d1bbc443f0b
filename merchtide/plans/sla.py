"""Which scheduled batches will miss their due time, why, and what to do next."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchtide import model
from merchtide.functions import clock as ck
from merchtide.functions import text as tx
from merchtide.functions.numeric import ratio, rounded, units
from merchtide.model import History
from merchtide.operators.rank import percentiles
from merchtide.operators.vectors import vectorize, with_mentions, with_nearest
from merchtide.sources import tables
from merchtide.sources.storage import stage, staging

DELAY_DIGITS = 6
HEALTH_DDL = "process string, status string, delay_min double, resource string, message string"
DEGRADED_TYPE = "array<struct<process:string,status:string,delay_min:double,resource:string,message:string>>"
MATCH_COLUMNS = ("process", "resource", "likely_root_causes", "mitigations",
                 "resources_to_check", "escalation_team")


# --- reference data -------------------------------------------------------


def default_health(spark: SparkSession) -> DataFrame:
    """Every known process, healthy and on time."""
    rows = [
        (p, "HEALTHY", 0.0, r, f"No delay reported for {p}.")
        for p, r in model.PROCESS_RESOURCES.items()
    ]
    return spark.createDataFrame(rows, HEALTH_DDL)


def starter_knowledge(spark: SparkSession) -> DataFrame:
    rows = [
        (e.kb_id, e.process, e.resource, list(e.symptoms), list(e.likely_root_causes),
         list(e.mitigations), list(e.resources_to_check), e.escalation_team)
        for e in model.STARTER_KNOWLEDGE
    ]
    return spark.createDataFrame(rows, model.KNOWLEDGE_DDL)


def knowledge_text() -> Column:
    """All the searchable text of a knowledge entry."""
    return F.concat_ws(
        " ", "process", "resource", "symptoms", "likely_root_causes", "mitigations",
        "resources_to_check",
    )


def vectorized_knowledge(kb: DataFrame) -> DataFrame:
    with_text = kb.withColumn("text_blob", knowledge_text())
    vectors = vectorize(with_text, "kb_id", "text_blob")
    return with_text.join(
        vectors.withColumnRenamed("vector", "embedding_vector"), "kb_id"
    )


# --- inputs ---------------------------------------------------------------


def batch_inputs(registry: DataFrame, now: Column) -> DataFrame:
    """Active batches with the times expected for the clock's hour.

    A batch without a flag counts as active.
    """
    hour = ck.truncated(now, "hour")
    return (
        registry.filter(F.coalesce("active_flag", F.lit(True)))
        .withColumn("prediction_time", now)
        .withColumn("_hour", hour)
        .withColumn(
            "data_available_time",
            ck.plus_minutes(F.col("_hour"), F.col("expected_data_available_minute")),
        )
        .withColumn("sla_due_time", ck.plus_minutes(F.col("_hour"), F.col("sla_offset_minutes")))
        .withColumn("actual_start_time", ck.plus_minutes(F.col("data_available_time"), F.lit(4)))
        .withColumn("status", F.lit("RUNNING"))
        .drop("_hour")
    )


def latest_health(events: DataFrame, at: Column | None = None) -> DataFrame:
    """Health per process from the events of the newest time.

    The event with the greatest id speaks for its process. Events without a
    process are left out, a missing status is UNKNOWN, a missing delay 0.
    """
    at = events.agg(F.max("event_time")).scalar() if at is None else at
    report = F.struct(
        F.coalesce("process_status", F.lit("UNKNOWN")).alias("status"),
        F.coalesce("process_delay_min", F.lit(0.0)).alias("delay_min"),
        F.col("current_resource").alias("resource"),
        F.col("message"),
    )
    return (
        events.filter(F.col("event_time") == at)
        .filter(F.coalesce(F.col("current_process") != "", F.lit(False)))
        .groupBy(F.col("current_process").alias("process"))
        .agg(F.max_by(report, "event_id").alias("_r"))
        .select("process", "_r.status", "_r.delay_min", "_r.resource", "_r.message")
    )


def process_health(events: DataFrame, at: Column | None = None) -> DataFrame:
    """Observed health, and the default for every process not observed."""
    observed = stage(latest_health(events, at), "health")
    unseen = default_health(events.sparkSession).join(observed, "process", "left_anti")
    return observed.unionByName(unseen)


def runs(events: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per (batch, start) with its duration and whether it was late.

    A run lasts until its last event; it is due at its start hour plus the
    batch's offset.
    """
    spans = events.groupBy("batch_id", "actual_start_time").agg(
        F.max("event_time").alias("ended_at")
    )
    due = ck.plus_minutes(
        ck.truncated(F.col("actual_start_time"), "hour"), F.col("sla_offset_minutes")
    )
    return spans.join(registry.select("batch_id", "sla_offset_minutes"), "batch_id", "left").select(
        "batch_id", "actual_start_time",
        (ck.micros(F.col("ended_at")) - ck.micros(F.col("actual_start_time"))).alias("_micros"),
        F.coalesce(F.col("ended_at") > due, F.lit(False)).alias("missed"),
    )


def duration_history(events: DataFrame, registry: DataFrame, now: Column | None = None,
                     days: int = 30) -> DataFrame:
    """Mean, p90 and p95 duration, success rate and recent misses per batch."""
    per_minute = F.lit(float(ck.MICROS_PER_MINUTE))
    seen = stage(runs(events, registry), "runs")
    recent = F.lit(True) if now is None else (
        F.col("actual_start_time") >= ck.plus_minutes(now, F.lit(-days * 24 * 60))
    )
    totals = seen.withColumn("_recent", recent).groupBy("batch_id").agg(
        F.count("*").alias("run_count"),
        ratio(F.sum("_micros"), F.count("*")).alias("_mean"),
        F.count_if("missed").alias("_missed"),
        F.count_if(F.col("missed") & F.col("_recent")).alias("historical_sla_miss_count_30d"),
    )
    spread = percentiles(
        seen, "batch_id", "_micros", "actual_start_time", {"_p90": 0.90, "_p95": 0.95}
    )
    return totals.join(spread, "batch_id").select(
        "batch_id", "run_count",
        (F.col("_mean") / per_minute).alias("avg_duration_min"),
        (F.col("_p90") / per_minute).alias("p90_duration_min"),
        (F.col("_p95") / per_minute).alias("p95_duration_min"),
        (ratio(F.col("run_count") - F.col("_missed"), F.col("run_count")) * 100.0)
        .alias("historical_success_rate_pct"),
        "historical_sla_miss_count_30d",
    )


def _assumed(rules: Mapping[str, History]) -> dict[str, Column]:
    """Each history column by the first rule whose text occurs in the batch name, else NULL."""
    fields = {
        "avg_duration_min": "avg", "p90_duration_min": "p90", "p95_duration_min": "p95",
        "historical_success_rate_pct": "success", "historical_sla_miss_count_30d": "misses",
    }

    def pick(field: str) -> Column:
        hits = [F.when(F.contains("batch_id", F.lit(part)), F.lit(getattr(record, field)))
                for part, record in rules.items()]
        return F.coalesce(*hits, F.lit(None))

    return {name: pick(field) for name, field in fields.items()}


def assumed_history(registry: DataFrame,
                    rules: Mapping[str, History] = model.ASSUMED_HISTORY) -> DataFrame:
    """History by a part of the batch name, for a start without any events.

    The first rule whose text occurs in the name applies; the empty text always
    does.
    """
    assumed = _assumed(rules)
    assumed["historical_sla_miss_count_30d"] = assumed["historical_sla_miss_count_30d"].cast("long")
    return registry.select("batch_id", *[c.alias(name) for name, c in assumed.items()])


def with_history(inputs: DataFrame, history: DataFrame,
                 rules: Mapping[str, History] | None = None) -> DataFrame:
    """Attach each batch's observed history, else the one assumed by name, else the default.

    Without ``rules`` nothing is assumed by name. A record is taken whole, never mixed.
    """
    assumed = _assumed({**(rules or {}), "": (rules or {}).get("", model.UNKNOWN_HISTORY)})
    known = history.select("batch_id", *assumed, F.lit(True).alias("_known"))
    joined = inputs.join(known, "batch_id", "left")
    filled = {
        name: F.when(F.col("_known"), F.col(name)).otherwise(value)
        for name, value in assumed.items()
    }
    return joined.withColumns(filled).drop("_known")


def with_process_delay(inputs: DataFrame, health: DataFrame) -> DataFrame:
    """Total delay over a batch's processes, and the ones that are not healthy.

    A process without health counts as UNKNOWN with no delay. A process reported twice
    counts once, with the report of the longest delay.
    """
    report = F.struct("delay_min", "status", "resource", "message")
    known = health.groupBy("process").agg(F.max(report).alias("_r")).select("process", "_r.*")
    steps = inputs.select("batch_id", F.posexplode("processes").alias("_pos", "process"))
    met = steps.join(known, "process", "left")
    seen = met.groupBy("batch_id").agg(
        F.array_sort(
            F.collect_list(F.struct("_pos", _report(F.col("process"), met).alias("r")))
        ).alias("_steps")
    ).select("batch_id", F.transform("_steps", lambda s: s["r"]).alias("_seen"))
    looked = inputs.join(seen, "batch_id", "left")
    seen = F.coalesce("_seen", F.array().cast(DEGRADED_TYPE))
    total = F.aggregate(
        seen, F.lit(0).cast("long"), lambda acc, s: acc + units(s["delay_min"], DELAY_DIGITS)
    )
    return (
        looked.withColumn("resource_delay_min", total / F.lit(10.0**DELAY_DIGITS))
        .withColumn("degraded_processes", F.filter(seen, lambda s: s["status"] != "HEALTHY"))
        .drop("_seen")
    )


def _report(process: Column, health) -> Column:
    """One process's state from the joined frame ``health``."""
    return F.struct(
        process.alias("process"),
        F.coalesce(health["status"], F.lit("UNKNOWN")).alias("status"),
        F.coalesce(health["delay_min"], F.lit(0.0)).alias("delay_min"),
        health["resource"].alias("resource"),
        health["message"].alias("message"),
    )


# --- estimate -------------------------------------------------------------


def with_timing(df: DataFrame) -> DataFrame:
    now = F.col("prediction_time")
    return (
        df.withColumn("_since_data", ck.minutes_between(F.col("data_available_time"), now))
        .withColumn("_since_start", ck.minutes_between(F.col("actual_start_time"), now))
        .withColumn("_remaining", ck.minutes_between(now, F.col("sla_due_time")))
    )


def with_completion(df: DataFrame) -> DataFrame:
    pressure = F.greatest(F.lit(0.0), F.col("_since_start") - F.col("avg_duration_min"))
    return (
        df.withColumn(
            "_total", F.col("p95_duration_min") + F.col("resource_delay_min") + pressure
        )
        .withColumn(
            "estimated_completion_time", ck.plus_minutes(F.col("actual_start_time"), F.col("_total"))
        )
        .withColumn(
            "_late",
            F.greatest(
                F.lit(0.0),
                ck.minutes_between(F.col("sla_due_time"), F.col("estimated_completion_time")),
            ),
        )
        .withColumn(
            "will_miss_sla", F.col("estimated_completion_time") > F.col("sla_due_time")
        )
    )


def risk_score(
    will_miss: Column, remaining: Column, p95: Column, delay: Column, misses: Column,
    criticality: Column,
) -> Column:
    # The points each sign of trouble adds.
    signs = (
        (will_miss, 45),
        (remaining < p95, 20),
        (delay >= 10, 15),
        (misses >= 3, 10),
        (criticality == "HIGH", 10),
    )
    total = F.lit(0)
    for sign, points in signs:
        total = total + F.when(sign, points).otherwise(0)
    return F.least(F.lit(100), total)


def risk_level(score: Column) -> Column:
    return (
        F.when(score >= 75, "CRITICAL").when(score >= 50, "HIGH").when(score >= 30, "MEDIUM")
        .otherwise("LOW")
    )


def predictions(inputs: DataFrame, history: DataFrame, health: DataFrame) -> DataFrame:
    """One row per batch with its estimate, score and level.

    A batch without observed runs has the history assumed by its name.
    """
    joined = with_process_delay(with_history(inputs, history, model.ASSUMED_HISTORY), health)
    timed = with_completion(with_timing(joined))
    scored = timed.withColumn(
        "risk_score",
        risk_score(
            F.col("will_miss_sla"), F.col("_remaining"), F.col("p95_duration_min"),
            F.col("resource_delay_min"), F.col("historical_sla_miss_count_30d"),
            F.col("criticality"),
        ),
    ).withColumn("risk_level", risk_level(F.col("risk_score")))
    return scored.select(
        "batch_id", "prediction_time", "business_domain", "criticality", "risk_level",
        "risk_score", "will_miss_sla", "sla_due_time", "data_available_time",
        "actual_start_time", "estimated_completion_time",
        rounded(F.col("_late"), 2).alias("estimated_minutes_late"),
        rounded(F.col("_since_data"), 2).alias("elapsed_since_data_available_min"),
        rounded(F.col("_since_start"), 2).alias("elapsed_since_start_min"),
        rounded(F.col("_remaining"), 2).alias("remaining_to_sla_min"),
        rounded(F.col("_total"), 2).alias("estimated_total_runtime_min"),
        F.col("avg_duration_min").alias("historical_avg_duration_min"),
        F.col("p90_duration_min").alias("historical_p90_duration_min"),
        F.col("p95_duration_min").alias("historical_p95_duration_min"),
        "historical_success_rate_pct", "historical_sla_miss_count_30d", "resource_delay_min",
        "processes", "degraded_processes",
    )


def payload() -> Column:
    """The event a prediction is published as, as JSON."""
    c = F.col
    return F.to_json(
        F.struct(
            F.lit("SLA_MISMATCH_PREDICTED").alias("event_type"),
            ck.iso(c("prediction_time")).alias("event_time"),
            "batch_id", "business_domain", "criticality", "risk_level", "risk_score",
            "will_miss_sla",
            ck.iso(c("sla_due_time")).alias("sla_due_time"),
            ck.iso(c("estimated_completion_time")).alias("estimated_completion_time"),
            "estimated_minutes_late",
            F.struct(
                ck.iso(c("data_available_time")).alias("data_available_time"),
                "elapsed_since_data_available_min",
            ).alias("data_availability"),
            F.struct(
                ck.iso(c("actual_start_time")).alias("actual_start_time"),
                "elapsed_since_start_min", "historical_avg_duration_min",
                "historical_p95_duration_min", "estimated_total_runtime_min",
            ).alias("runtime_stats"),
            F.struct(
                c("historical_avg_duration_min").alias("avg_duration_min"),
                c("historical_p90_duration_min").alias("p90_duration_min"),
                c("historical_p95_duration_min").alias("p95_duration_min"),
                "historical_success_rate_pct", "historical_sla_miss_count_30d",
            ).alias("historical_stats"),
            c("processes").alias("processes_involved"),
            "degraded_processes",
        )
    )


def prediction_records(found: DataFrame) -> DataFrame:
    """Rows of the prediction table; the id is a hash, so a rerun repeats it."""
    return found.select(
        F.md5(F.concat_ws("|", "batch_id", ck.iso(F.col("prediction_time"))))
        .alias("prediction_id"),
        "batch_id", "prediction_time", "business_domain", "criticality", "risk_level",
        "risk_score", "will_miss_sla", "sla_due_time", "data_available_time",
        "actual_start_time", "estimated_completion_time", "estimated_minutes_late",
        "elapsed_since_data_available_min", "elapsed_since_start_min",
        "historical_avg_duration_min", "historical_p95_duration_min", "resource_delay_min",
        F.to_json("degraded_processes").alias("degraded_processes_json"),
        payload().alias("event_payload_json"),
    )


def triggered(found: DataFrame) -> DataFrame:
    """Predictions that call for root-cause matching."""
    return found.filter(F.col("will_miss_sla") | F.col("risk_level").isin("HIGH", "CRITICAL"))


def run_summary(found: DataFrame) -> DataFrame:
    hit = F.col("will_miss_sla") | F.col("risk_level").isin("HIGH", "CRITICAL")
    return found.agg(
        F.count("*").alias("batches_checked"), F.count_if(hit).alias("agent_trigger_count")
    )


# --- root cause -----------------------------------------------------------


def query_text() -> Column:
    """What is known about a prediction, as search text."""
    trouble = F.flatten(
        F.transform(
            "degraded_processes",
            lambda d: F.array(
                d["process"], F.coalesce(d["resource"], F.lit("")),
                F.coalesce(d["message"], F.lit("")),
            ),
        )
    )
    return F.concat_ws(" ", "batch_id", "risk_level", F.concat_ws(" ", "processes"), trouble)


def process_bonus() -> Column:
    """Points for entries of each involved and each degraded process of a prediction."""
    none = F.array().cast("array<string>")
    involved = F.coalesce("processes", none)
    degraded = F.coalesce(F.transform("degraded_processes", lambda d: d["process"]), none)

    def points(p: Column) -> Column:
        named = F.size(F.filter(involved, lambda x: x == p))
        late = F.size(F.filter(degraded, lambda x: x == p))
        return named * 0.25 + late * 0.40

    return F.transform(
        F.array_union(involved, degraded),
        lambda p: F.struct(p.alias("term"), points(p).alias("points")))


def with_knowledge(found: DataFrame, kb: DataFrame, top: int = 3, **options) -> DataFrame:
    """Add ``matches``, the best knowledge entries per prediction."""
    return with_nearest(
        found.withColumn("_query", tx.hashed_vector(query_text())),
        "batch_id", "_query", kb, "kb_id", "embedding_vector", MATCH_COLUMNS,
        process_bonus(), "process", top, **options,
    ).drop("_query")


def rca_items(matches: Column) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["score"].alias("match_score"),
            m["entry"]["kb_id"].alias("kb_id"),
            m["entry"]["process"].alias("process"),
            m["entry"]["resource"].alias("resource"),
            m["entry"]["likely_root_causes"].alias("likely_root_causes"),
            m["entry"]["mitigations"].alias("recommended_mitigations"),
            m["entry"]["resources_to_check"].alias("resources_to_check"),
            m["entry"]["escalation_team"].alias("escalation_team"),
        ),
    )


def next_best_actions(matches: Column) -> Column:
    """General actions first, then two mitigations per match, without repeats."""
    no_action = F.array().cast(T.ArrayType(T.StringType()))

    def only_if(condition: Column, action: str) -> Column:
        return F.when(condition, F.array(F.lit(action))).otherwise(no_action)

    advised = F.flatten(
        F.transform(
            matches,
            lambda m: F.transform(
                F.slice(m["entry"]["mitigations"], 1, 2),
                lambda step: F.concat(m["entry"]["process"], F.lit(": "), step),
            ),
        )
    )
    return tx.first_occurrences(
        F.concat(
            only_if(F.col("risk_level").isin("HIGH", "CRITICAL"), model.NOTIFY_ACTION),
            only_if(F.col("estimated_minutes_late") > 0, model.PRIORITIZE_ACTION),
            advised,
        )
    )


def summary_text() -> Column:
    return F.concat(
        F.lit("Batch "), "batch_id", F.lit(" is predicted to miss SLA by "),
        F.col("estimated_minutes_late").cast("string"), F.lit(" minutes. Risk level is "),
        "risk_level", F.lit("."),
    )


def rca_response(matches: Column) -> Column:
    """The answer to a prediction as one nested record: causes, checks and next steps."""
    return F.struct(
        F.lit("SLA_MISMATCH_RCA_RESPONSE").alias("event_type"),
        "batch_id", "risk_level", "risk_score", "estimated_minutes_late",
        summary_text().alias("summary"),
        rca_items(matches).alias("rca_items"),
        next_best_actions(matches).alias("next_best_actions"),
    )


def recommendations(found: DataFrame, kb: DataFrame, top: int = 3) -> DataFrame:
    """Rows of the recommendation table for the predictions that call for one.

    ``response`` is the nested record that is published; the other columns repeat its
    parts flat, for those who read the table.
    """
    matched = with_knowledge(triggered(found), kb, top)
    answered = matched.withColumn("response", rca_response(F.col("matches")))
    return answered.select(
        F.md5(F.concat_ws("|", F.lit("rca"), "batch_id", ck.iso(F.col("prediction_time"))))
        .alias("recommendation_id"),
        "batch_id",
        F.col("prediction_time").alias("event_time"),
        "risk_level", "risk_score", "will_miss_sla",
        F.col("response.summary").alias("rca_summary"),
        F.to_json("response.rca_items").alias("rca_items_json"),
        "response.next_best_actions",
        "response",
    )


# --- keyword context ------------------------------------------------------


def with_context(events: DataFrame, key: str, text: str, kb: DataFrame, kb_key: str,
                 resolution: str, position: str, **options) -> DataFrame:
    """Add ``context``: every runbook whose key has a word in the text, in order.

    All matches are kept; an event without one gets the default sentence.
    """
    found = with_mentions(
        events, key, text, kb, position, F.split(kb_key, "_"), [kb_key, resolution], **options)
    lines = F.transform(
        "matches",
        lambda m: F.concat(
            F.lit("["), m["entry"][kb_key], F.lit("]: "), m["entry"][resolution]
        ),
    )
    text_out = F.when(F.size("matches") == 0, F.lit(model.NO_CONTEXT)).otherwise(
        F.array_join(lines, "\n")
    )
    return found.withColumn("context", text_out).drop("matches")


def prompt(table: Column, latency: Column, limit: Column, status: Column,
           context: Column) -> Column:
    """Instruction text for a root-cause report on one delayed table."""
    return F.concat(
        F.lit("Table: "), F.coalesce(table, F.lit("Unknown")),
        F.lit("\nLatency in minutes: "), F.coalesce(latency.cast("string"), F.lit("0")),
        F.lit("\nAllowed minutes: "), F.coalesce(limit.cast("string"), F.lit("0")),
        F.lit("\nStatus: "), F.coalesce(status, F.lit("CRITICAL")),
        F.lit("\nKnown remedies:\n"), context,
        F.lit("\nWrite the root cause, an impact score from 1 to 10 and the steps to recover."),
    )


# --- the whole run --------------------------------------------------------


def monitor(
    registry: DataFrame, events: DataFrame, knowledge: DataFrame, now: Column,
    health_events: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(predictions, recommendations) of one run.

    ``health_events`` gives the process reports where they are kept apart from
    the run events.
    """
    found = predictions(
        batch_inputs(registry, now),
        duration_history(events, registry, now),
        process_health(events if health_events is None else health_events),
    )
    found = stage(found, "predictions")
    return found, recommendations(found, vectorized_knowledge(knowledge))


def run_monitor(
    spark: SparkSession, ops_dir: str, registry: DataFrame, events: DataFrame,
    knowledge: DataFrame, now: datetime, health_events: DataFrame | None = None,
) -> dict[str, int]:
    """Refresh the reference tables, append predictions and recommendations, sum up."""
    def stamp(df: DataFrame) -> DataFrame:
        return df.withColumn("created_at", F.lit(now))

    with staging(spark):
        tables.replace_table(stamp(registry), f"{ops_dir}/sla_batch_registry")
        tables.replace_table(
            stamp(vectorized_knowledge(knowledge)), f"{ops_dir}/sla_rca_kb_vectorized"
        )
        found, advice = monitor(
            registry, events, knowledge, F.lit(now).cast("timestamp_ntz"), health_events
        )
        tables.append_rows(
            stamp(prediction_records(found)), f"{ops_dir}/sla_prediction_results"
        )
        tables.append_rows(stamp(advice), f"{ops_dir}/sla_agent_recommendations")
        return run_summary(found).first().asDict()
