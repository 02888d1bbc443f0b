"""Batch-risk, root-cause and text-matching queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide import model
from merchtide.functions import clock as ck
from merchtide.functions import text as tx
from merchtide.functions.numeric import rounded
from merchtide.operators.columns import harmonize_numbers
from merchtide.operators.vectors import slot_sums, vectorize, with_nearest
from merchtide.plans import sla
from merchtide.queries import query
from merchtide.queries.twin import rnd, sql, text
from merchtide.sources import storage, tables


def hourly_reports(d) -> DataFrame:
    """Runtime events whose time is their hour, so the newest hour is one snapshot."""
    return d.runtime_events.withColumn("event_time", ck.truncated(F.col("event_time"), "hour"))


def inputs(d) -> DataFrame:
    return sla.batch_inputs(d.batches, d.run_clock)


def health(d) -> DataFrame:
    return sla.process_health(hourly_reports(d))


def history(d) -> DataFrame:
    return sla.duration_history(d.runtime_events, d.batches, d.run_clock)


def found(d) -> DataFrame:
    return sla.predictions(inputs(d), history(d), health(d))


def knowledge(d) -> DataFrame:
    return sla.vectorized_knowledge(sla.starter_knowledge(d.spark))


def advice(d) -> DataFrame:
    return sla.recommendations(found(d), knowledge(d))


# --- inputs and history ---------------------------------------------------


@query("prj15_active_batches", sql("SELECT batch_id FROM inp"))
def _(d):
    return inputs(d).select("batch_id")


@query("sla01_batch_inputs", sql(
    "SELECT batch_id, data_available_time, sla_due_time, actual_start_time, 'RUNNING' AS status "
    "FROM inp"))
def _(d):
    return inputs(d).select(
        "batch_id", "data_available_time", "sla_due_time", "actual_start_time", "status")


@query("agg18_latest_health", sql("SELECT * FROM obs"))
def _(d):
    return sla.latest_health(hourly_reports(d))


@query("jn08_health_over_defaults", sql("SELECT process, status, delay_min FROM hlt"))
def _(d):
    return health(d).select("process", "status", "delay_min")


@query("sla02_process_health", sql("SELECT * FROM hlt"))
def _(d):
    return health(d)


HISTORY = (
    "batch_id, run_count, " + ", ".join(
        f"{rnd(c, 6)} AS {c}" for c in (
            "avg_duration_min", "p90_duration_min", "p95_duration_min",
            "historical_success_rate_pct"))
    + ", historical_sla_miss_count_30d"
)


@query("agg14_duration_history", sql(f"SELECT {HISTORY} FROM his"))
def _(d):
    names = ("avg_duration_min", "p90_duration_min", "p95_duration_min",
             "historical_success_rate_pct")
    return history(d).withColumns({n: rounded(F.col(n), 6) for n in names})


@query("agg14_assumed_history", sql(
    "SELECT batch_id, CASE WHEN contains(batch_id, 'STOCK') THEN 47.5e0 "
    "WHEN contains(batch_id, 'MARKETING') THEN 30.3e0 WHEN contains(batch_id, 'ORDERS') THEN 35.3e0 "
    "ELSE 28e0 END AS avg_duration_min, CASE WHEN contains(batch_id, 'STOCK') THEN 5 "
    "WHEN contains(batch_id, 'ORDERS') THEN 2 ELSE 1 END::BIGINT AS historical_sla_miss_count_30d "
    "FROM (SELECT concat('B_', CASE c_custkey % 4 WHEN 0 THEN 'STOCK' WHEN 1 THEN 'MARKETING' "
    "WHEN 2 THEN 'ORDERS' ELSE 'OTHER' END, '_', c_custkey) AS batch_id FROM customer)"))
def _(d):
    kinds = F.array(*[F.lit(k) for k in ("STOCK", "MARKETING", "ORDERS", "OTHER")])
    kind = kinds[(F.col("c_custkey") % 4).cast("int")]
    named = d.raw("customer").select(
        F.concat(F.lit("B_"), kind, F.lit("_"), "c_custkey").alias("batch_id"))
    return sla.assumed_history(named).select(
        "batch_id", "avg_duration_min", "historical_sla_miss_count_30d")


@query("jn06_history_or_default", sql(
    f"SELECT batch_id, {rnd('p95_duration_min', 6)} AS p95_duration_min, "
    "historical_sla_miss_count_30d FROM wh"))
def _(d):
    return sla.with_history(inputs(d), history(d)).select(
        "batch_id", rounded(F.col("p95_duration_min"), 6).alias("p95_duration_min"),
        "historical_sla_miss_count_30d")


@query("jn07_batch_process_health", sql("SELECT batch_id, process, status, delay_min FROM stph"))
def _(d):
    steps = inputs(d).select("batch_id", F.explode("processes").alias("process"))
    known = health(d).select("process", "status", "delay_min")
    return steps.join(known, "process", "left").select(
        "batch_id", "process", F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        F.coalesce("delay_min", F.lit(0.0)).alias("delay_min"))


@query("agg11_process_delay", sql("SELECT batch_id, resource_delay_min FROM dly"))
def _(d):
    return sla.with_process_delay(inputs(d), health(d)).select("batch_id", "resource_delay_min")


@query("agg12_degraded_processes", sql("SELECT batch_id, degraded FROM dly"))
def _(d):
    names = F.transform("degraded_processes", lambda p: p["process"])
    return sla.with_process_delay(inputs(d), health(d)).select(
        "batch_id", F.array_join(names, ",").alias("degraded"))


# --- estimate -------------------------------------------------------------


@query("sla03_timing", sql(
    f"SELECT batch_id, {rnd('since_data', 6)} AS since_data, {rnd('since_start', 6)} AS since_start, "
    f"{rnd('remaining', 6)} AS remaining FROM tim"))
def _(d):
    c = F.col
    timed = sla.with_timing(inputs(d))
    return timed.select(
        "batch_id", rounded(c("_since_data"), 6).alias("since_data"),
        rounded(c("_since_start"), 6).alias("since_start"),
        rounded(c("_remaining"), 6).alias("remaining"))


@query("sla04_completion", sql(
    "SELECT batch_id, eta AS estimated_completion_time, estimated_minutes_late, will_miss_sla "
    "FROM prd"))
def _(d):
    return found(d).select(
        "batch_id", "estimated_completion_time", "estimated_minutes_late", "will_miss_sla")


@query("sla05_risk_score", sql("SELECT batch_id, risk_score FROM prd"))
def _(d):
    return found(d).select("batch_id", "risk_score")


@query("sla06_risk_level", sql("SELECT risk_level, COUNT(*) AS batches FROM prd GROUP BY 1"))
def _(d):
    return found(d).groupBy("risk_level").agg(F.count("*").alias("batches"))


def fixed(value: Column, digits: int) -> Column:
    """A number in whole units of its last digit, as comparable text."""
    return F.rint(value * 10.0**digits).cast("long").cast("string")


def fixed_twin(value: str, digits: int) -> str:
    return f"CAST(CAST(round_even({value} * 1e{digits}, 0) AS BIGINT) AS VARCHAR)"


def late_steps(steps: Column) -> Column:
    """The degraded processes with all they report, a line each."""
    return F.array_join(
        F.transform(steps, lambda s: F.concat_ws(
            ";", s["process"], s["status"], fixed(s["delay_min"], 6), s["resource"], s["message"])),
        "\n")


@query("sla07_prediction_rows", sql(
    "SELECT md5(concat_ws('|', batch_id, strftime(prediction_time, '%Y-%m-%dT%H:%M:%S'))) "
    "AS prediction_id, batch_id, prediction_time, business_domain, criticality, risk_level, "
    "risk_score, will_miss_sla, sla_due_time, data_available_time, actual_start_time, "
    "eta AS estimated_completion_time, estimated_minutes_late, "
    f"{rnd('since_data', 2)} AS elapsed_since_data_available_min, "
    f"{rnd('since_start', 2)} AS elapsed_since_start_min, "
    f"{rnd('avg_duration_min', 6)} AS historical_avg_duration_min, "
    f"{rnd('p95_duration_min', 6)} AS historical_p95_duration_min, resource_delay_min, "
    "late_steps AS degraded_processes, 'SLA_MISMATCH_PREDICTED' AS published_as FROM prd"))
def _(d):
    rows = sla.prediction_records(found(d))
    steps = F.from_json("degraded_processes_json", sla.DEGRADED_TYPE)
    return rows.select(
        "prediction_id", "batch_id", "prediction_time", "business_domain", "criticality",
        "risk_level", "risk_score", "will_miss_sla", "sla_due_time", "data_available_time",
        "actual_start_time", "estimated_completion_time", "estimated_minutes_late",
        "elapsed_since_data_available_min", "elapsed_since_start_min",
        rounded(F.col("historical_avg_duration_min"), 6).alias("historical_avg_duration_min"),
        rounded(F.col("historical_p95_duration_min"), 6).alias("historical_p95_duration_min"),
        "resource_delay_min", late_steps(steps).alias("degraded_processes"),
        F.get_json_object("event_payload_json", "$.event_type").alias("published_as"))


PAYLOAD_SHAPE = (
    "event_type string, event_time string, batch_id string, business_domain string, criticality string, "
    "risk_level string, risk_score int, will_miss_sla boolean, sla_due_time string, "
    "estimated_completion_time string, estimated_minutes_late double, "
    "data_availability struct<data_available_time:string,elapsed_since_data_available_min:double>, "
    "runtime_stats struct<actual_start_time:string,elapsed_since_start_min:double,"
    "historical_avg_duration_min:double,historical_p95_duration_min:double,estimated_total_runtime_min:double>, "
    "historical_stats struct<avg_duration_min:double,p90_duration_min:double,p95_duration_min:double,"
    "historical_success_rate_pct:double,historical_sla_miss_count_30d:long>, "
    f"processes_involved array<string>, degraded_processes {sla.DEGRADED_TYPE}"
)


def iso_twin(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%dT%H:%M:%S')"


@query("sla08_event_payload", sql(
    "SELECT batch_id, 'SLA_MISMATCH_PREDICTED' AS event_type, "
    f"{iso_twin('prediction_time')} AS event_time, business_domain, criticality, risk_level, risk_score, "
    f"will_miss_sla, {iso_twin('sla_due_time')} AS due, left({iso_twin('eta')}, 19) AS completion, "
    f"{fixed_twin('estimated_minutes_late', 2)} AS late, {iso_twin('data_available_time')} AS data_at, "
    f"{fixed_twin(rnd('since_data', 2), 2)} AS since_data, {iso_twin('actual_start_time')} AS started, "
    f"{fixed_twin(rnd('since_start', 2), 2)} AS since_start, {fixed_twin(rnd('total', 2), 2)} AS runtime, "
    f"{fixed_twin('avg_duration_min', 6)} AS mean, {fixed_twin('p90_duration_min', 6)} AS p90, "
    f"{fixed_twin('p95_duration_min', 6)} AS p95, {fixed_twin('historical_success_rate_pct', 6)} AS success, "
    "CAST(historical_sla_miss_count_30d AS BIGINT) AS misses, array_to_string(processes, ',') AS involved, "
    "late_steps AS degraded FROM prd"))
def _(d):
    c = F.col
    opened = found(d).select(F.from_json(sla.payload(), PAYLOAD_SHAPE).alias("e"))
    return opened.select(
        "e.batch_id", "e.event_type", "e.event_time", "e.business_domain", "e.criticality",
        "e.risk_level", "e.risk_score", "e.will_miss_sla", c("e.sla_due_time").alias("due"),
        F.left(c("e.estimated_completion_time"), F.lit(19)).alias("completion"),
        fixed(c("e.estimated_minutes_late"), 2).alias("late"),
        c("e.data_availability.data_available_time").alias("data_at"),
        fixed(c("e.data_availability.elapsed_since_data_available_min"), 2).alias("since_data"),
        c("e.runtime_stats.actual_start_time").alias("started"),
        fixed(c("e.runtime_stats.elapsed_since_start_min"), 2).alias("since_start"),
        fixed(c("e.runtime_stats.estimated_total_runtime_min"), 2).alias("runtime"),
        fixed(c("e.historical_stats.avg_duration_min"), 6).alias("mean"),
        fixed(c("e.historical_stats.p90_duration_min"), 6).alias("p90"),
        fixed(c("e.historical_stats.p95_duration_min"), 6).alias("p95"),
        fixed(c("e.historical_stats.historical_success_rate_pct"), 6).alias("success"),
        c("e.historical_stats.historical_sla_miss_count_30d").alias("misses"),
        F.array_join("e.processes_involved", ",").alias("involved"),
        late_steps(c("e.degraded_processes")).alias("degraded"))


@query("prj16_trigger", sql("SELECT batch_id, risk_level FROM trg"))
def _(d):
    return sla.triggered(found(d)).select("batch_id", "risk_level")


@query("agg17_run_summary", sql(
    "SELECT COUNT(*) AS batches_checked, CAST(count_if(will_miss_sla OR risk_level IN ('HIGH', "
    "'CRITICAL')) AS BIGINT) AS agent_trigger_count FROM prd"))
def _(d):
    return sla.run_summary(found(d))


# --- vectors and matches --------------------------------------------------


def micro(vector) -> Column:
    """A vector's values in millionths, as comparable text."""
    return F.array_join(F.transform(vector, lambda x: F.rint(x * 1e6).cast("long")), ",")


def micro_twin(source: str, key: str) -> str:
    return (
        f"SELECT {key}, string_agg(CAST(CAST(round(v * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY i) "
        f"AS vector FROM {source} GROUP BY 1"
    )


@query("sla09_document_vectors", sql(micro_twin("dv", "doc_id")))
def _(d):
    return vectorize(d.raw("documents"), "doc_id", "text").select(
        "doc_id", micro("vector").alias("vector"))


@query("sla09_short_text_vectors", sql(micro_twin("bv", "item_id")))
def _(d):
    return d.raw("benchmark").select(
        "item_id", micro(tx.hashed_vector(F.col("text"))).alias("vector"))


@query("agg15_slot_sums", sql("SELECT doc_id, i AS slot, c AS total FROM dv"))
def _(d):
    sums = slot_sums(d.raw("documents"), "doc_id", "text")
    return sums.select("doc_id", F.posexplode("counts").alias("slot", "total"))


@query("sla10_query_text", sql(
    "SELECT batch_id, string_agg(t, ' ' ORDER BY t) AS words FROM qv_tok GROUP BY 1"))
def _(d):
    words = F.sort_array(tx.tokens(sla.query_text()))
    return sla.triggered(found(d)).select("batch_id", F.array_join(words, " ").alias("words"))


@query("sla11_match_score", sql("SELECT batch_id, kb_id, score, place FROM mtc"))
def _(d):
    matched = sla.with_knowledge(sla.triggered(found(d)), knowledge(d))
    rows = matched.select("batch_id", F.posexplode("matches").alias("pos", "m"))
    return rows.select(
        "batch_id", F.col("m.entry.kb_id").alias("kb_id"), F.col("m.score").alias("score"),
        (F.col("pos") + 1).cast("long").alias("place"))


def document_matches(d, top: int) -> DataFrame:
    docs = vectorize(d.raw("documents"), "doc_id", "text")
    items = vectorize(d.raw("benchmark"), "item_id", "text")
    return with_nearest(docs, "doc_id", "vector", items, "item_id", "vector", top=top)


@query("jn09_document_matches", sql(
    "SELECT doc_id, item_id, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id "
    "ORDER BY score DESC, item_id) AS place FROM dbs) WHERE place <= 3"))
def _(d):
    rows = document_matches(d, 3).select("doc_id", F.explode("matches").alias("m"))
    return rows.select("doc_id", "m.entry.item_id", "m.score")


@query("win02_best_match", sql(
    "SELECT doc_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id "
    "ORDER BY score DESC, item_id) AS place FROM dbs) WHERE place = 1"))
def _(d):
    best = F.col("matches")[0]["entry"]["item_id"]
    return document_matches(d, 1).select("doc_id", best.alias("item_id"))


@query("jn09_conversation_matches", sql(
    "SELECT doc_id, turn_id, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id "
    "ORDER BY score DESC, turn_id) AS place FROM cbs) WHERE place <= 3"))
def _(d):
    turns = d.raw("conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.groupBy("turn_id").agg(F.max("text").alias("text"))
    docs = vectorize(d.raw("documents"), "doc_id", "text")
    # Small blocks, so that the set is spread over several at every size.
    found = with_nearest(
        docs, "doc_id", "vector", vectorize(turns, "turn_id", "text"), "turn_id", "vector",
        block_bytes=1 << 14)
    rows = found.select("doc_id", F.explode("matches").alias("m"))
    return rows.select("doc_id", "m.entry.turn_id", "m.score")


# --- answers --------------------------------------------------------------


@query("sla12_rca_items", sql(
    "SELECT batch_id, place, m.kb_id, m.process, score AS match_score, k.team AS escalation_team, "
    "array_to_string(k.causes, '|') AS causes FROM mtc m JOIN kb k ON m.kb_id = k.kb_id"))
def _(d):
    matched = sla.with_knowledge(sla.triggered(found(d)), knowledge(d))
    items = matched.select("batch_id", F.posexplode(sla.rca_items(F.col("matches"))).alias("pos", "r"))
    return items.select(
        "batch_id", (F.col("pos") + 1).cast("long").alias("place"), "r.kb_id", "r.process",
        "r.match_score", "r.escalation_team",
        F.array_join("r.likely_root_causes", "|").alias("causes"))


ACTIONS_TWIN = (
    "SELECT t.batch_id, concat_ws('|', CASE WHEN t.risk_level IN ('HIGH', 'CRITICAL') THEN "
    f"{text(model.NOTIFY_ACTION)} END, CASE WHEN t.estimated_minutes_late > 0 THEN "
    f"{text(model.PRIORITIZE_ACTION)} END, a.advised) AS actions FROM trg t JOIN (SELECT batch_id, "
    "string_agg(concat(process, ': ', mitigations[1], '|', process, ': ', mitigations[2]), '|' "
    "ORDER BY place) AS advised FROM mtc GROUP BY 1) a ON t.batch_id = a.batch_id"
)


@query("sla13_next_actions", sql(ACTIONS_TWIN))
def _(d):
    matched = sla.with_knowledge(sla.triggered(found(d)), knowledge(d))
    return matched.select(
        "batch_id", F.array_join(sla.next_best_actions(F.col("matches")), "|").alias("actions"))


ITEMS_TWIN = (
    "SELECT m.batch_id, string_agg(concat_ws(';', " + fixed_twin("m.score", 4) + ", k.kb_id, k.process, "
    "k.resource, array_to_string(k.causes, '|'), array_to_string(k.mitigations, '|'), "
    "array_to_string(k.checks, '|'), k.team), chr(10) ORDER BY place) AS items "
    "FROM mtc m JOIN kb k ON m.kb_id = k.kb_id GROUP BY 1"
)
SUMMARY_TWIN = (
    "concat('Batch ', batch_id, ' is predicted to miss SLA by ', CAST(estimated_minutes_late AS VARCHAR), "
    "' minutes. Risk level is ', risk_level, '.')"
)
ITEM_TYPE = (
    "array<struct<match_score:double,kb_id:string,process:string,resource:string,"
    "likely_root_causes:array<string>,recommended_mitigations:array<string>,"
    "resources_to_check:array<string>,escalation_team:string>>"
)


def item_lines(items: Column) -> Column:
    """All that the items of an answer say, a line each."""
    return F.array_join(
        F.transform(items, lambda i: F.concat_ws(
            ";", fixed(i["match_score"], 4), i["kb_id"], i["process"], i["resource"],
            F.array_join(i["likely_root_causes"], "|"), F.array_join(i["recommended_mitigations"], "|"),
            F.array_join(i["resources_to_check"], "|"), i["escalation_team"])),
        "\n")


@query("sla14_recommendation_rows", sql(
    f"SELECT md5(concat_ws('|', 'rca', batch_id, {iso_twin('prediction_time')})) AS recommendation_id, "
    "batch_id, prediction_time AS event_time, risk_level, risk_score, will_miss_sla, "
    f"{SUMMARY_TWIN} AS rca_summary, items, actions "
    f"FROM trg JOIN ({ITEMS_TWIN}) i USING (batch_id) JOIN ({ACTIONS_TWIN}) a USING (batch_id)"))
def _(d):
    return advice(d).select(
        "recommendation_id", "batch_id", "event_time", "risk_level", "risk_score", "will_miss_sla",
        "rca_summary", item_lines(F.from_json("rca_items_json", ITEM_TYPE)).alias("items"),
        F.array_join("next_best_actions", "|").alias("actions"))


@query("sla14_response_record", sql(
    "SELECT 'SLA_MISMATCH_RCA_RESPONSE' AS event_type, batch_id, risk_level, risk_score, "
    f"estimated_minutes_late, {SUMMARY_TWIN} AS summary, items, actions "
    f"FROM trg JOIN ({ITEMS_TWIN}) i USING (batch_id) JOIN ({ACTIONS_TWIN}) a USING (batch_id)"))
def _(d):
    return advice(d).select("response.*").select(
        "event_type", "batch_id", "risk_level", "risk_score", "estimated_minutes_late", "summary",
        item_lines(F.col("rca_items")).alias("items"),
        F.array_join("next_best_actions", "|").alias("actions"))


RUNBOOKS = [
    (e.kb_id, e.process, e.mitigations[0]) for e in model.STARTER_KNOWLEDGE
]
CONTEXT_TWIN = (
    "SELECT e.event_id, coalesce(string_agg('[' || r.runbook || ']: ' || r.remedy, chr(10) "
    f"ORDER BY r.kb_id), {text(model.NO_CONTEXT)}) AS context FROM rte e LEFT JOIN (VALUES "
    + ", ".join(f"({text(a)}, {text(b)}, {text(c)})" for a, b, c in RUNBOOKS)
    + ") r(kb_id, runbook, remedy) ON len(list_filter(string_split(r.runbook, '_'), "
    "lambda w: contains(lower(e.message), w))) > 0 GROUP BY 1"
)


def contexts(d) -> DataFrame:
    runbooks = d.spark.createDataFrame(RUNBOOKS, "kb_id string, runbook string, remedy string")
    events = d.runtime_events.select("event_id", "message", "current_process", "process_delay_min",
                                     "process_status")
    return sla.with_context(events, "event_id", "message", runbooks, "runbook", "remedy", "kb_id")


@query("jn10_keyword_join", sql(CONTEXT_TWIN))
def _(d):
    return contexts(d).select("event_id", "context")


@query("sla15_keyword_context", sql(
    f"SELECT context = {text(model.NO_CONTEXT)} AS fallback, COUNT(*) AS row_count "
    f"FROM ({CONTEXT_TWIN}) GROUP BY 1"))
def _(d):
    return contexts(d).groupBy((F.col("context") == model.NO_CONTEXT).alias("fallback")).agg(
        F.count("*").alias("row_count"))


@query("sla16_prompt", sql(
    "SELECT e.event_id, concat('Table: ', coalesce(e.current_process, 'Unknown'), chr(10), "
    "'Latency in minutes: ', CAST(CAST(round_even(e.process_delay_min, 0) AS BIGINT) AS VARCHAR), chr(10), "
    "'Allowed minutes: 45', chr(10), 'Status: ', coalesce(e.process_status, 'CRITICAL'), chr(10), "
    "'Known remedies:', chr(10), c.context, chr(10), "
    "'Write the root cause, an impact score from 1 to 10 and the steps to recover.') AS prompt "
    f"FROM rte e JOIN ({CONTEXT_TWIN}) c ON e.event_id = c.event_id"))
def _(d):
    c = F.col
    return contexts(d).select(
        "event_id",
        sla.prompt(
            c("current_process"), F.rint("process_delay_min").cast("long"), F.lit(45),
            c("process_status"), c("context"),
        ).alias("prompt"))


@query("sla17_reference_refresh", sql(
    "SELECT batch_id, criticality, expected_data_available_minute, sla_offset_minutes FROM reg"))
def _(d):
    path = storage.scratch_path(d.spark, "registry")
    tables.replace_table(d.batches, path)
    tables.replace_table(d.batches, path)
    return harmonize_numbers(tables.read_table(d.spark, path)).select(
        "batch_id", "criticality", "expected_data_available_minute", "sla_offset_minutes")


@query("flow10_sla_monitor", sql(
    "SELECT t.batch_id, t.risk_level, t.risk_score, t.estimated_minutes_late, a.actions FROM trg t "
    f"JOIN ({ACTIONS_TWIN}) a ON t.batch_id = a.batch_id"))
def _(d):
    predicted, recommended = sla.monitor(
        d.batches, d.runtime_events, sla.starter_knowledge(d.spark), d.run_clock,
        hourly_reports(d))
    late = predicted.select("batch_id", "estimated_minutes_late")
    return recommended.join(late, "batch_id").select(
        "batch_id", "risk_level", "risk_score", "estimated_minutes_late",
        F.array_join("next_best_actions", "|").alias("actions"))


