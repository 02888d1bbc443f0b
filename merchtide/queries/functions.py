"""Scalar-function queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from merchtide.functions import clock as ck
from merchtide.functions import metrics as mt
from merchtide.functions import text as tx
from merchtide.functions.numeric import clamped, rounded
from merchtide.operators.vectors import vectorize
from merchtide.plans import gold
from merchtide.queries import query
from merchtide.queries.gold import push
from merchtide.queries.twin import SIGN, SLOT, minutes, plus_minutes, rnd, sql, token_list


@query("fn01_reason_text", sql(
    "SELECT hour_key, sku, 'Demand spike ' || CAST(demand_spike_pct AS VARCHAR) || '%, CVR ' || "
    "CAST(cvr_pct AS VARCHAR) || '%, ROAS ' || CAST(nullif(roas, 0) AS VARCHAR) || "
    "'x, stock cover ' || CAST(stock_cover_hrs AS VARCHAR) || ' hrs' AS reason FROM joined"))
def _(d):
    rows = gold.with_stock_and_product(d.marketing, d.stock, d.product)
    known = F.when(F.col("roas") != 0, F.col("roas"))
    return rows.select(
        "hour_key", "sku",
        mt.reason(
            F.col("demand_spike_pct"), F.col("cvr_pct"), known, F.col("stock_cover_hrs")
        ).alias("reason"))


@query("fn02_number_text", sql(
    "SELECT sku, printf('%.2f', unit_price) AS fixed, CAST(margin_pct AS VARCHAR) AS shortest "
    "FROM product"))
def _(d):
    return d.product.select(
        "sku", F.format_string("%.2f", "unit_price").alias("fixed"),
        F.col("margin_pct").cast("string").alias("shortest"))


@query("fn03_clean_names",
       "SELECT p_partkey, replace(replace(lower(trim(p_name)), ' ', '_'), '-', '_') AS name FROM part")
def _(d):
    return d.raw("part").select(
        "p_partkey", F.translate(F.lower(F.trim("p_name")), " -", "__").alias("name"))


@query("fn04_tokens", sql(
    f"SELECT doc_id, len(l) AS token_count, list_max(l) AS last_token FROM (SELECT doc_id, "
    f"{token_list('text')} AS l FROM documents)"))
def _(d):
    listed = d.raw("documents").select("doc_id", tx.tokens(F.col("text")).alias("t"))
    return listed.select(
        "doc_id", F.size("t").cast("long").alias("token_count"),
        F.array_max("t").alias("last_token"))


@query("fn05_joined_text", sql(
    "SELECT batch_id, concat_ws(' ', batch_id, business_domain, array_to_string(processes, ' ')) "
    "AS blob FROM reg"))
def _(d):
    return d.batches.select(
        "batch_id", F.concat_ws(" ", "batch_id", "business_domain", "processes").alias("blob"))


@query("fn06_hash_slots", sql(
    f"SELECT conv_id, turn, {SLOT} AS slot, {SIGN} AS sign FROM (SELECT conv_id, turn, "
    f"text AS t FROM conversations)"))
def _(d):
    return d.raw("conversations").select(
        "conv_id", "turn", tx.hash_slot(F.col("text")).alias("slot"),
        tx.hash_sign(F.col("text")).alias("sign"))


@query("fn07_keyword_test", sql(
    "SELECT event_id, contains(lower(message), 'stock') OR contains(lower(message), 'click') AS hit "
    "FROM rte"))
def _(d):
    return d.runtime_events.select(
        "event_id", tx.mentions_key(F.col("message"), F.lit("stock_click")).alias("hit"))


@query("fn08_interpolated_text", sql(
    "SELECT sku, 'Product ' || sku || ' holds ' || base_stock || ' pieces.' AS sentence FROM product"))
def _(d):
    return d.product.select(
        "sku", F.format_string("Product %s holds %d pieces.", "sku", "base_stock").alias("sentence"))


@query("fn09_prefixed_pair", sql(
    "SELECT batch_id, concat(batch_id, ': ', processes[1], '|', batch_id, ': ', processes[2]) "
    "AS steps FROM reg"))
def _(d):
    steps = F.transform(
        F.slice("processes", 1, 2), lambda p: F.concat(F.col("batch_id"), F.lit(": "), p))
    return d.batches.select("batch_id", F.array_join(steps, "|").alias("steps"))


@query("fn10_plus_hours", "SELECT event_id, ts + INTERVAL 3 HOUR AS until FROM events")
def _(d):
    return d.raw("events").select("event_id", F.expr("ts + INTERVAL 3 HOURS").alias("until"))


@query("fn11_minutes_between", sql(
    f"SELECT event_id, {rnd(minutes('actual_start_time', 'event_time'), 6)} AS minutes FROM rte"))
def _(d):
    gap = ck.minutes_between(F.col("actual_start_time"), F.col("event_time"))
    return d.runtime_events.select("event_id", rounded(gap, 6).alias("minutes"))


@query("fn12_hour_start", "SELECT event_id, date_trunc('hour', ts) AS hour FROM events")
def _(d):
    return d.raw("events").select("event_id", ck.truncated(F.col("ts"), "hour").alias("hour"))


@query("fn13_plus_minutes", f"SELECT event_id, {plus_minutes('ts', 'value / 10')} AS later FROM events")
def _(d):
    return d.raw("events").select(
        "event_id", ck.plus_minutes(F.col("ts"), F.col("value") / 10.0).alias("later"))


@query("fn14_hour_key",
       "SELECT event_id, strftime(ts, '%Y%m%d%H') AS hour_key, "
       "strftime(ts + INTERVAL 330 MINUTE, '%Y%m%d%H') AS india_key FROM events")
def _(d):
    return d.raw("events").select(
        "event_id", ck.hour_key(F.col("ts")).alias("hour_key"),
        ck.hour_key(F.col("ts"), "Asia/Kolkata").alias("india_key"))


@query("fn15_parse_and_iso",
       "SELECT event_id, date_trunc('second', ts) AS parsed, "
       "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events")
def _(d):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return d.raw("events").select(
        "event_id", ck.parsed(text).alias("parsed"), ck.iso(F.col("ts")).alias("iso"))


@query("fn16_run_stamp", sql("SELECT sku, TIMESTAMP '2024-02-01 06:00:00' AS created_at FROM product"))
def _(d):
    run_at = datetime(2024, 2, 1, 6, tzinfo=timezone.utc)
    rows = gold.stamped(d.product.select("sku"), run_at)
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("fn17_clamps", "SELECT event_id, least(100e0, greatest(5e0, value)) AS bounded FROM events")
def _(d):
    return d.raw("events").select(
        "event_id", clamped(F.col("value"), low=5.0, high=100.0).alias("bounded"))


@query("fn18_rounding",
       f"SELECT event_id, {rnd('value / 7', 2)} AS two, {rnd('value / 7', 4)} AS four, "
       f"{rnd('event_id / 4', 1)} AS one FROM events")
def _(d):
    seventh = F.col("value") / 7.0
    return d.raw("events").select(
        "event_id", rounded(seventh, 2).alias("two"), rounded(seventh, 4).alias("four"),
        rounded(F.col("event_id") / 4.0, 1).alias("one"))


@query("fn19_unit_length", sql(
    f"SELECT doc_id, {rnd('sqrt(SUM(v * v))', 4)} AS length FROM dv GROUP BY 1"))
def _(d):
    vectors = vectorize(d.raw("documents"), "doc_id", "text")
    length = F.sqrt(tx.dot(F.col("vector"), F.col("vector")))
    return vectors.select("doc_id", rounded(length, 4).alias("length"))


@query("fn20_dot_product",
       f"SELECT vec_id, {rnd('list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])', 6)} "
       "AS self_dot FROM embeddings")
def _(d):
    wide = F.col("embedding").cast("array<double>")
    return d.raw("embeddings").select("vec_id", rounded(tx.dot(wide, wide), 6).alias("self_dot"))


@query("fn21_first_and_member", sql(
    "SELECT batch_id, array_to_string(processes[1:2], ',') AS first_two, "
    "list_contains(processes, 'audit_export') AS exports FROM reg"))
def _(d):
    return d.batches.select(
        "batch_id", F.array_join(F.slice("processes", 1, 2), ",").alias("first_two"),
        F.array_contains("processes", "audit_export").alias("exports"))


@query("fn22_json_text", sql(
    "SELECT sku, '{\"sku\":\"' || sku || '\",\"stock\":[' || base_stock || ']}' AS json FROM product"))
def _(d):
    body = F.struct("sku", F.array("base_stock").alias("stock"))
    return d.product.select("sku", F.to_json(body).alias("json"))


@query("fn23_stable_ids", "SELECT event_id, md5(concat_ws('|', user_id, event_type)) AS id FROM events")
def _(d):
    return d.raw("events").select(
        "event_id", F.md5(F.concat_ws("|", "user_id", "event_type")).alias("id"))


@query("fn24_null_defaults", sql(
    "SELECT event_id, coalesce(process_status, 'UNKNOWN') AS status FROM rte"))
def _(d):
    return d.runtime_events.select(
        "event_id", F.coalesce("process_status", F.lit("UNKNOWN")).alias("status"))


@query("fn25_safe_casts",
       "SELECT event_id, TRY_CAST(event_type AS INTEGER) AS no_number, "
       "TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS number FROM events")
def _(d):
    return d.raw("events").select(
        "event_id", F.col("event_type").try_cast("int").alias("no_number"),
        F.col("value").cast("string").try_cast("double").alias("number"))


@query("ded02_first_occurrences", sql(
    "SELECT c.conv_id, c.turn, coalesce(w.words, '') AS words FROM conversations c LEFT JOIN ("
    "SELECT conv_id, turn, string_agg(t, ' ' ORDER BY place) AS words FROM (SELECT conv_id, turn, t, "
    "min(place) AS place FROM (SELECT conv_id, turn, unnest(l) AS t, generate_subscripts(l, 1) AS place "
    f"FROM (SELECT conv_id, turn, {token_list('text')} AS l FROM conversations)) GROUP BY ALL) "
    "GROUP BY ALL) w ON c.conv_id = w.conv_id AND c.turn = w.turn"))
def _(d):
    words = tx.first_occurrences(tx.tokens(F.col("text")))
    # A text without a token is kept, with no words.
    return d.raw("conversations").select(
        "conv_id", "turn", F.array_join(F.coalesce(words, F.array()), " ").alias("words"))


@query("fn01_top_reasons", sql("SELECT sku, reason FROM acts"))
def _(d):
    return gold.recommended_actions(push(d)).select("sku", "reason")
