"""Files, tables, silver, quality, audit and streaming queries.

The files these queries read are written from the whole test tables first, the
way an upstream system would drop them.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchtide import model
from merchtide.model import TableSpec
from merchtide.operators.columns import cast_to_schema, harmonize_numbers, normalize_columns
from merchtide.operators.dedupe import keep_newest
from merchtide.operators.quality import check_table, duplicate_groups, split_invalid
from merchtide.operators.snapshot import at_latest
from merchtide.operators.upsert import upsert
from merchtide.plans import dashboard as db
from merchtide.plans import gold, layers, silver
from merchtide.plans.layers import Lake
from merchtide.queries import query
from merchtide.queries.twin import sql
from merchtide.sources import bronze, files, storage, tables
from merchtide.sources.audit import audited
from merchtide.streaming import ingest

RUN_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def header_case(name: str) -> str:
    """The mixed-case headers upstream files carry, as in Product_Name."""
    return "_".join(part.capitalize() for part in name.split("_"))


def drop_csv(df: DataFrame, folder: str, packed: bool = False) -> None:
    """Write a frame as CSV files with mixed-case headers, next to what is there.

    ``packed`` files take a fraction of the disk; each is read by one task.
    """
    renamed = df.toDF(*[header_case(c) for c in df.columns])
    # Fast packing: a level that packs a little better takes several times as long.
    packing = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"} if packed else {}
    with storage.last_use(df.sparkSession):
        renamed.write.mode("append").options(**files.CSV_OPTIONS, **packing).csv(folder)


def source_rows(d, spec: TableSpec) -> DataFrame:
    """The test frame that stands for a raw source, with the table's columns."""
    rows = {
        model.PRODUCT: lambda: d.product,
        model.MARKETING: lambda: d.marketing,
        model.STOCK: lambda: d.stock,
        model.TRANSACTIONS: lambda: d.transactions,
        model.ORDERS_HOURLY: lambda: gold.orders_summary(d.marketing),
        model.CATEGORY_HOURLY: lambda: gold.category_summary(d.marketing),
        model.CHANNEL_HOURLY: lambda: d.channel,
        model.RESTOCK: lambda: d.restock,
    }[spec]()
    return rows.select(*[c for c in spec.columns if c in rows.columns])


def new_lake(d) -> Lake:
    return Lake(storage.scratch_path(d.spark, "lake"))


def dropped_lake(d, specs=model.REGISTRY, packed: bool = False) -> Lake:
    """A lake whose raw folder holds CSV drops of the sources."""
    lake = new_lake(d)
    for spec in specs:
        drop_csv(source_rows(d, spec), f"{lake.layer('raw')}/{spec.source}", packed)
    return lake


def typed_transactions(d) -> DataFrame:
    return cast_to_schema(source_rows(d, model.TRANSACTIONS), model.TRANSACTIONS)


# --- sources and sinks ----------------------------------------------------

PRODUCT_TWIN = (
    "SELECT sku, product_name, category, brand, CAST(round(unit_price, 2) AS DOUBLE) AS unit_price, "
    "margin_pct, CAST(base_stock AS BIGINT) AS base_stock, initial_stock_cover_hrs FROM product"
)


@query("src01_csv_scan", sql(PRODUCT_TWIN))
def _(d):
    lake = dropped_lake(d, [model.PRODUCT])
    rows = files.read_source(d.spark, lake.layer("raw"), model.PRODUCT)
    return harmonize_numbers(cast_to_schema(rows, model.PRODUCT))


@query("src03_append_new_column", sql(
    "SELECT c_custkey AS custkey, c_name AS name, CASE WHEN c_acctbal < 0 THEN c_mktsegment END "
    "AS segment FROM customer"))
def _(d):
    path = storage.scratch_path(d.spark, "bronze")
    c = d.raw("customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    tables.append_rows(c.filter("balance >= 0").select("custkey", "name"), path)
    tables.append_rows(c.filter("balance < 0").select("custkey", "name", "segment"), path)
    return tables.read_table(d.spark, path, merge=True)


@query("src04_lineage", sql(
    "SELECT sku, 'product_master' AS _source_name, 'product_master' AS folder, true AS stamped "
    "FROM product"))
def _(d):
    lake = dropped_lake(d, [model.PRODUCT])
    rows = files.read_source(d.spark, lake.layer("raw"), model.PRODUCT)
    marked = normalize_columns(files.with_lineage(rows, model.PRODUCT.source))
    return marked.select(
        "sku", "_source_name",
        F.element_at(F.split("_input_file_name", "/"), -2).alias("folder"),
        F.col("_ingested_at").isNotNull().alias("stamped"))


def streamed_bronze(d) -> Lake:
    """Transactions dropped in two lots, the stream run after each and once more."""
    lake = new_lake(d)
    spec = model.TRANSACTIONS
    for status in ("F", "O"):
        lot = d.transactions.filter(F.col("line_status") == status).select(*spec.columns)
        drop_csv(lot, f"{lake.layer('raw')}/{spec.source}")
        layers.ingest_incremental(d.spark, lake, [spec], run_id=f"lot-{status}", multi_line=False)
    layers.ingest_incremental(d.spark, lake, [spec], run_id="nothing-new", multi_line=False)
    return lake


TX_TWIN = (
    "SELECT order_id, sku, CAST(quantity AS BIGINT) AS quantity, order_value, traffic_channel "
    "FROM tx"
)


@query("src05_stream_ingest", sql(TX_TWIN))
def _(d):
    lake = streamed_bronze(d)
    rows = tables.read_table(d.spark, lake.table("bronze", "raw_order_transactions"))
    typed = harmonize_numbers(cast_to_schema(rows, model.TRANSACTIONS))
    return typed.select("order_id", "sku", "quantity", "order_value", "traffic_channel")


@query("src06_stream_bad_rows", sql(
    "SELECT sku, base_stock % 8 = 0 AS kept_whole FROM product"))
def _(d):
    lake = new_lake(d)
    spec = model.RESTOCK
    folder = f"{lake.layer('raw')}/{spec.source}"
    # Some rows carry one field more than the header announces.
    line = F.concat_ws(
        ",", "sku", "product_name", F.lit("2024-02-01 00:00:00"), F.lit("10"), F.lit("Planned"),
        F.when(F.col("base_stock") % 8 == 0, F.lit("surplus")))
    d.product.select(line.alias(",".join(spec.columns))).write.option("header", True).option(
        "quote", "").option("sep", "\x01").csv(folder)
    target = ingest.ingest_new_files(
        d.spark, lake.layer("raw"), lake.layer("bronze"), lake.layer("checkpoints"), spec)
    rows = tables.read_table(d.spark, target)
    return rows.select("sku", F.col(ingest.CORRUPT).isNotNull().alias("kept_whole"))


@query("src06_schema_tracking", sql(
    "SELECT sku, product_name, status, restock_units, CASE WHEN part = 2 THEN 'B' || restock_units END "
    "AS bay, part FROM (SELECT *, CAST(substr(sku, 2) AS BIGINT) % 3 AS part FROM rst)"))
def _(d):
    lake = new_lake(d)
    spec = model.RESTOCK
    columns = list(spec.columns)
    lots = d.restock.withColumn("part", F.substring("sku", 2, 20).cast("long") % 3)
    for part, names in enumerate((columns, columns[::-1], [*columns[2:], "bay", *columns[:2]])):
        # The same columns, then in another order, then with one more among them.
        lot = lots.where(F.col("part") == part).withColumn("bay", F.concat(F.lit("B"), "restock_units"))
        drop_csv(lot.select(*names), f"{lake.layer('raw')}/{spec.source}")
        layers.ingest_incremental(d.spark, lake, [spec], run_id=f"drop-{part}")
    rows = bronze.read_bronze(
        d.spark, lake.table("bronze", f"raw_{spec.source}"), spec,
        ingest.schema_path(lake.layer("checkpoints"), spec), typed=True)
    return rows.select("sku", "product_name", "status", "restock_units", "bay").withColumn(
        "part", F.substring("sku", 2, 20).cast("long") % 3)


@query("src06_schema_record", sql(
    "SELECT * FROM (VALUES (0, 'sku', 'string'), (1, 'product_name', 'string'), "
    "(2, 'scheduled_restock_timestamp', 'timestamp'), (3, 'restock_units', (SELECT CASE WHEN "
    "count(restock_units) > 0 THEN 'bigint' END FROM rst)), (4, 'status', 'string')) "
    "AS t(position, column_name, type)"))
def _(d):
    lake = dropped_lake(d, [model.RESTOCK])
    layers.ingest_incremental(d.spark, lake, [model.RESTOCK], run_id="run-1")
    path = ingest.schema_path(lake.layer("checkpoints"), model.RESTOCK)
    rows = d.spark.read.schema(bronze.RECORD_DDL).parquet(path)
    newest = rows.where(F.col("version") == rows.agg(F.max("version")).scalar())
    return newest.select("position", F.col("column").alias("column_name"), "type")


@query("src07_table_scan", sql("SELECT hour_key, sku, orders FROM mkt"))
def _(d):
    path = storage.scratch_path(d.spark, "marketing")
    tables.replace_table(d.marketing, path)
    return tables.read_table(d.spark, path).select("hour_key", "sku", "orders")


@query("src08_json_metadata", sql(
    "SELECT batch_id, criticality, expected_data_available_minute, sla_offset_minutes, active_flag, "
    "array_to_string(processes, ',') AS processes FROM reg"))
def _(d):
    path = storage.scratch_path(d.spark, "registry-json")
    d.batches.write.json(path)
    rows = files.read_json_table(d.spark, path, model.BATCH_REGISTRY_DDL, multi_line=False)
    return harmonize_numbers(rows).select(
        "batch_id", "criticality", "expected_data_available_minute", "sla_offset_minutes",
        "active_flag", F.array_join("processes", ",").alias("processes"))


@query("src09_snapshot_replace", sql("SELECT * FROM stk"))
def _(d):
    path = storage.scratch_path(d.spark, "snapshot")
    tables.replace_table(d.product, path)
    tables.replace_table(d.stock, path)
    return tables.read_table(d.spark, path)


def batches_of_transactions(d) -> tuple[DataFrame, DataFrame]:
    """Finished lines, loaded first, and open lines, loaded over them."""
    newest = [
        keep_newest(
            d.transactions.filter(F.col("line_status") == s), ["order_id"], ["shipped_at"])
        for s in ("F", "O")
    ]
    return newest[0], newest[1]


@query("src10_upsert_table", sql("SELECT * FROM tx2"))
def _(d):
    path = storage.scratch_path(d.spark, "transactions")
    for batch in batches_of_transactions(d):
        tables.upsert_table(batch, path, ["order_id"], ["category"])
    rows = tables.read_table(d.spark, path)
    return rows.select(*d.transactions.columns)


@query("src10_upsert_snapshot", sql(
    "SELECT o_orderkey AS orderkey, CASE o_orderstatus WHEN 'F' THEN 'closed' ELSE o_orderstatus END "
    "AS status FROM orders"))
def _(d):
    path = storage.scratch_path(d.spark, "orders")
    o = d.raw("orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"))
    tables.upsert_table(o.filter("status <> 'O'"), path, ["orderkey"])
    changed = o.filter("status <> 'P'").withColumn(
        "status", F.when(F.col("status") == "F", "closed").otherwise(F.col("status")))
    tables.upsert_table(changed, path, ["orderkey"])
    return tables.read_table(d.spark, path)


@query("src11_ops_append", sql(
    "SELECT run_id, 'fact_order_transactions' AS table_name, 'unique_key:order_id' AS rule_name, "
    "(SELECT COUNT(*) FROM (SELECT order_id FROM tx GROUP BY 1 HAVING COUNT(*) > 1)) AS failed_count "
    "FROM (VALUES ('first'), ('second')) r(run_id)"))
def _(d):
    path = storage.scratch_path(d.spark, "quality")
    rows = storage.stage(d.transactions.select("order_id"), "order-ids")
    for run in ("first", "second"):
        found = check_table(
            rows, "fact_order_transactions", unique_key=["order_id"], run_id=run,
            checked_at=RUN_AT)
        tables.append_typed(found, path, model.QUALITY_DDL)
    return tables.read_table(d.spark, path).select(
        "run_id", "table_name", "rule_name", "failed_count")


@query("src12_published_view", sql(
    f"SELECT {', '.join(gold.LOW_STOCK_COLUMNS)} FROM dec WHERE stock_cover_hrs < 12"))
def _(d):
    path = storage.scratch_path(d.spark, "pushnow")
    decided = gold.with_decision(gold.with_stock_and_product(d.marketing, d.stock, d.product))
    # Written three times below, joined once.
    rows = storage.stage(decided, "decided")
    tables.replace_table(rows.filter("stock_cover_hrs < 6"), path)
    name = tables.publish_view(
        d.spark, "vw_low_stock_throttle_list", path, gold.LOW_STOCK_COLUMNS,
        "stock_cover_hrs < 12.0")
    # Two rewrites after the view was made: it shows the last one.
    tables.replace_table(rows.filter("stock_cover_hrs >= 6"), path)
    tables.replace_table(rows, path)
    return d.spark.table(name)


@query("src14_clustered_compaction", sql("SELECT * FROM tx"))
def _(d):
    path = storage.scratch_path(d.spark, "fragmented")
    tables.replace_table(d.transactions.repartition(32), path)
    tables.compact_table(d.spark, path, model.TRANSACTIONS.cluster_by)
    return tables.read_table(d.spark, path)


@query("src16_partitioned_layout", sql(
    "SELECT hour_key, sku, orders, units_sold FROM mkt WHERE timestamp = (SELECT t FROM now_)"))
def _(d):
    path = storage.scratch_path(d.spark, "partitioned")
    tables.write_partitioned(d.marketing, path, ["hour_key"])
    rows = tables.read_table(d.spark, path, d.marketing.schema)
    return at_latest(rows, "hour_key").select("hour_key", "sku", "orders", "units_sold")


# --- silver ---------------------------------------------------------------


@query("prj01_normalize_names",
       "SELECT p_partkey AS sku, p_name AS product_name, p_retailprice AS unit_price FROM part")
def _(d):
    messy = d.raw("part").select(
        F.col("p_partkey").alias(" SKU "), F.col("p_name").alias("Product Name"),
        F.col("p_retailprice").alias("Unit-Price"))
    return normalize_columns(messy)


@query("prj02_cast_to_schema", sql(
    "SELECT concat('P', user_id) AS sku, CAST(trunc(value) AS BIGINT) AS sessions, "
    "CAST(NULL AS BIGINT) AS orders, value AS roas, CAST(NULL AS DOUBLE) AS push_score "
    "FROM events"))
def _(d):
    raw = d.raw("events").select(
        F.concat(F.lit("P"), "user_id").alias("SKU"), F.col("value").cast("string").alias("Sessions"),
        F.col("event_type").alias("Orders"), F.col("value").cast("string").alias("ROAS"),
        F.lit("dropped").alias("Unknown"))
    typed = harmonize_numbers(cast_to_schema(raw, model.MARKETING))
    return typed.select("sku", "sessions", "orders", "roas", "push_score")


@query("prj03_lineage_kept", sql(
    "SELECT sku, 'parts' AS _source_name FROM product"))
def _(d):
    raw = d.product.withColumn("_source_name", F.lit("parts")).withColumn("_other", F.lit(1))
    typed = cast_to_schema(raw, model.PRODUCT)
    return typed.select("sku", *[c for c in typed.columns if c.startswith("_")])


@query("ded01_newest_per_key", sql("SELECT * FROM tx1"))
def _(d):
    return keep_newest(d.transactions, ["order_id"], ["shipped_at"])


@query("jn05_upsert_rows", sql("SELECT * FROM tx2"))
def _(d):
    finished, opened = batches_of_transactions(d)
    return upsert(finished, opened, ["order_id"])


# --- quality and audit ----------------------------------------------------


def _rules_twin(rules: list[tuple[str, str]], source: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS rule_name, CAST(({count}) AS BIGINT) AS failed_count"
        for name, count in rules)
    return (
        f"SELECT rule_name, CASE WHEN failed_count = 0 THEN 'PASS' ELSE 'FAIL' END AS rule_status, "
        f"failed_count FROM ({parts})")


RESULT = ("rule_name", "rule_status", "failed_count")


@query("dq01_not_null", sql(_rules_twin([
    ("not_null:batch_id", "SELECT COUNT(*) FROM rte WHERE batch_id IS NULL"),
    ("not_null:current_process", "SELECT COUNT(*) FROM rte WHERE current_process IS NULL"),
    ("not_null:process_status", "SELECT COUNT(*) FROM rte WHERE process_status IS NULL"),
    ("not_null:no_such_column", "SELECT COUNT(*) FROM rte"),
], "rte")))
def _(d):
    return check_table(
        d.runtime_events, "sla_runtime_events",
        not_null=["batch_id", "current_process", "process_status", "no_such_column"],
    ).select(*RESULT)


DUPLICATES = "SELECT COUNT(*) FROM (SELECT order_id FROM tx GROUP BY 1 HAVING COUNT(*) > 1)"


@query("dq02_unique_key", sql(_rules_twin([("unique_key:order_id", DUPLICATES)], "tx")))
def _(d):
    return check_table(
        d.transactions, "fact_order_transactions", unique_key=["order_id"]).select(*RESULT)


@query("dq03_non_negative", sql(_rules_twin([
    ("non_negative:units_sold", "SELECT COUNT(*) FROM led_a WHERE units_sold < 0"),
    ("non_negative:closing_stock", "SELECT COUNT(*) FROM led_a WHERE closing_stock - 20 < 0"),
], "led_a")))
def _(d):
    moved = d.ledger("floor").withColumn("closing_stock", F.col("closing_stock") - 20)
    return check_table(
        moved, "stock", non_negative=["units_sold", "closing_stock"]).select(*RESULT)


@query("dq05_result_rows", sql(
    "SELECT 'run-1' AS run_id, 'silver' AS layer, 'dim_product' AS table_name, rule_name, rule_status, "
    "failed_count, TIMESTAMP '2024-02-01 00:00:00' AS checked_at FROM (" + _rules_twin([
        ("not_null:sku", "SELECT COUNT(*) FROM product WHERE sku IS NULL"),
        ("not_null:product_name", "SELECT COUNT(*) FROM product WHERE base_stock % 8 = 0"),
        ("not_null:category", "SELECT COUNT(*) FROM product WHERE category IS NULL"),
        ("unique_key:sku", "SELECT COUNT(*) FROM (SELECT CASE WHEN base_stock % 8 = 1 THEN 'P0' ELSE sku END "
                           "AS k FROM product GROUP BY 1 HAVING COUNT(*) > 1)")], "product") + ")"))
def _(d):
    spec = model.PRODUCT
    rest = F.col("base_stock") % 8
    broken = d.product.withColumns({
        "sku": F.when(rest == 1, "P0").otherwise(F.col("sku")),
        "product_name": F.when(rest != 0, F.col("product_name"))})
    found = check_table(
        broken, spec.target, spec.required, spec.keys, spec.non_negative, "run-1", "silver", RUN_AT)
    return found.withColumn("checked_at", F.col("checked_at").cast("timestamp_ntz"))


@query("dq06_quarantine", sql(
    "SELECT event_id, current_process, current_process IS NOT NULL AS kept FROM rte"))
def _(d):
    good, bad = split_invalid(
        d.runtime_events.select("event_id", "current_process"), ["current_process"])
    return good.withColumn("kept", F.lit(True)).unionByName(bad.withColumn("kept", F.lit(False)))


@query("srt12_quality_board", sql(_rules_twin([
    ("not_null:order_id", "SELECT COUNT(*) FROM tx WHERE order_id IS NULL"),
    ("not_null:order_timestamp", "SELECT COUNT(*) FROM tx WHERE order_timestamp IS NULL"),
    ("not_null:sku", "SELECT COUNT(*) FROM tx WHERE sku IS NULL"), ("unique_key:order_id", DUPLICATES)], "tx")))
def _(d):
    found = silver.silver_checks(typed_transactions(d), model.TRANSACTIONS)
    return db.quality_board(found).select(*RESULT)


@query("agg08_row_count", sql(
    "SELECT 'marketing' AS table_name, COUNT(*) AS row_count FROM mkt UNION ALL "
    "SELECT 'stock', COUNT(*) FROM stk"))
def _(d):
    counts = []
    for name, rows in (("marketing", d.marketing), ("stock", d.stock)):
        path = storage.scratch_path(d.spark, name)
        tables.replace_table(rows, path)
        counts.append(tables.read_table(d.spark, path).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"))
    return counts[0].unionByName(counts[1])


@query("agg16_duplicate_keys", sql(
    "SELECT COUNT(*) AS duplicate_keys FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
    "GROUP BY 1, 2 HAVING COUNT(*) > 1)"))
def _(d):
    return duplicate_groups(d.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("aud01_audit_rows", sql(
    "SELECT 'load' AS task_name, 'SUCCESS' AS status, COUNT(*) AS row_count, "
    "CAST(NULL AS VARCHAR) AS message FROM mkt UNION ALL "
    "SELECT 'break', 'FAILED', NULL, 'source missing'"))
def _(d):
    root = storage.scratch_path(d.spark, "audit")
    log = f"{root}/etl_audit_log"
    with audited(d.spark, log, "run-1", "load", "marketing") as outcome:
        outcome["row_count"] = tables.append_rows(d.marketing, f"{root}/marketing")
    try:
        with audited(d.spark, log, "run-1", "break", "marketing"):
            raise FileNotFoundError("source missing")
    except FileNotFoundError:
        pass
    return tables.read_table(d.spark, log).select("task_name", "status", "row_count", "message")


@query("aud02_stream_audit", sql(
    "SELECT 'lot-F' AS run_id, 'SUCCESS' AS status, count(*) FILTER (WHERE line_status = 'F') AS row_count FROM tx "
    "UNION ALL SELECT 'lot-O', 'SUCCESS', count(*) FILTER (WHERE line_status = 'O') FROM tx "
    "UNION ALL SELECT 'nothing-new', 'SUCCESS', 0"))
def _(d):
    log = streamed_bronze(d).table("ops", "etl_audit_log")
    return tables.read_table(d.spark, log).select("run_id", "status", "row_count")


# --- streaming ------------------------------------------------------------


@query("str01_append_once", sql(
    "SELECT order_id, COUNT(*) AS copies FROM tx GROUP BY 1"))
def _(d):
    lake = streamed_bronze(d)
    rows = tables.read_table(d.spark, lake.table("bronze", "raw_order_transactions"))
    return rows.groupBy("order_id").agg(F.count("*").alias("copies"))


@query("str02_stream_upsert", sql(
    "SELECT sku, product_name, scheduled_restock_timestamp, restock_units, 'Done' AS status FROM rst"))
def _(d):
    lake = new_lake(d)
    spec = model.RESTOCK
    for status in ("Planned", "Done"):
        lot = d.restock.withColumn("status", F.lit(status))
        drop_csv(lot, f"{lake.layer('raw')}/{spec.source}")
        layers.ingest_incremental(d.spark, lake, [spec], run_id=status)
        ingest.upsert_new_rows(
            d.spark, lake.layer("bronze"), lake.layer("silver"), lake.layer("ops"),
            lake.layer("checkpoints"), spec)
    rows = harmonize_numbers(layers.read_silver(d.spark, lake, spec))
    return rows.select(*spec.columns).withColumn(
        "scheduled_restock_timestamp", F.col("scheduled_restock_timestamp").cast("timestamp_ntz"))


@query("str02_stream_quarantine", sql(
    "SELECT product_name, CASE CAST(substr(sku, 2) AS BIGINT) % 8 WHEN 0 THEN 'columns' WHEN 1 THEN 'key' "
    "ELSE 'silver' END AS place FROM product"))
def _(d):
    lake = new_lake(d)
    spec = model.RESTOCK
    # Some rows have a field more than the header, some have no key.
    rest = F.substring("sku", 2, 20).cast("long") % 8
    line = F.concat_ws(
        ",", F.when(rest == 1, "").otherwise(F.col("sku")), "product_name",
        F.lit("2024-02-01 00:00:00"), F.lit("10"), F.lit("Planned"), F.when(rest == 0, F.lit("surplus")))
    d.product.select(line.alias(",".join(spec.columns))).write.option("header", True).option(
        "quote", "").option("sep", "\x01").csv(f"{lake.layer('raw')}/{spec.source}")
    layers.ingest_incremental(d.spark, lake, [spec], run_id="run-1")
    ingest.upsert_new_rows(
        d.spark, lake.layer("bronze"), lake.layer("silver"), lake.layer("ops"),
        lake.layer("checkpoints"), spec)
    loaded = layers.read_silver(d.spark, lake, spec)
    rejected = tables.read_table(d.spark, lake.table("ops", silver.QUARANTINE))
    return loaded.select("product_name", F.lit("silver").alias("place")).union(
        rejected.select(F.get_json_object("row", "$.product_name"), "reason"))


# --- whole builds ---------------------------------------------------------

# Of every table what names a row and one of its numbers, with the twin's table.
CONTENT = {
    model.PRODUCT: ("product", "sku", "product_name", "base_stock"),
    model.MARKETING: ("mkt", "hour_key", "sku", "orders"),
    model.STOCK: ("stk", "hour_key", "sku", "closing_stock"),
    model.TRANSACTIONS: ("tx", "order_id", "sku", "quantity"),
    model.ORDERS_HOURLY: ("ohs", "hour_key", "hour_key", "total_orders"),
    model.CATEGORY_HOURLY: ("cat", "hour_key", "category", "orders"),
    model.CHANNEL_HOURLY: ("chn", "hour_key", "channel", "orders"),
    model.RESTOCK: ("rst", "sku", "status", "restock_units"),
}


def content_twin(specs, name: str, **other_table: str) -> str:
    parts = [
        f"SELECT '{getattr(s, name)}' AS table_name, {a} AS first_key, {b} AS second_key, "
        f"CAST({n} AS BIGINT) AS measure FROM {other_table.get(s.source, cte)}"
        for s, (cte, a, b, n) in CONTENT.items() if s in specs]
    return sql(" UNION ALL ".join(parts))


def content(specs, name: str, read) -> DataFrame:
    """The rows of all tables under one another; ``read`` gives a table by its spec."""
    parts = []
    for spec in specs:
        _, a, b, n = CONTENT[spec]
        parts.append(normalize_columns(read(spec)).select(
            F.lit(getattr(spec, name)).alias("table_name"), F.col(a).alias("first_key"),
            F.col(b).alias("second_key"), F.col(n).cast("long").alias("measure")))
    return reduce(DataFrame.unionByName, parts)


def bronze_content(d, lake: Lake) -> DataFrame:
    return content(model.REGISTRY, "source", lambda spec: tables.read_table(
        d.spark, lake.table("bronze", f"raw_{spec.source}")))


@query("flow01_bronze_batch", content_twin(model.REGISTRY, "source"))
def _(d):
    lake = dropped_lake(d)
    layers.ingest_batch(d.spark, lake, run_id="run-1")
    return bronze_content(d, lake)


@query("flow02_bronze_stream", content_twin(model.REGISTRY, "source"))
def _(d):
    lake = dropped_lake(d)
    layers.ingest_incremental(d.spark, lake, run_id="run-1")
    return bronze_content(d, lake)


SILVER_SPECS = (model.PRODUCT, model.MARKETING, model.STOCK, model.CATEGORY_HOURLY,
                model.CHANNEL_HOURLY, model.TRANSACTIONS)


def silver_lake(d) -> Lake:
    # Packed, as raw files, bronze and silver are all there at the end.
    lake = dropped_lake(d, SILVER_SPECS, packed=True)
    layers.ingest_batch(d.spark, lake, SILVER_SPECS, run_id="run-1", multi_line=False)
    layers.build_silver(d.spark, lake, SILVER_SPECS, run_id="run-1")
    return lake


# One ingest gave all rows, so of those with one key the greatest by their values stays.
GREATEST_TX = (
    "(SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY order_id "
    "ORDER BY order_timestamp DESC, sku DESC, quantity DESC) = 1)"
)


@query("flow03_silver_build", content_twin(SILVER_SPECS, "target", order_transactions=GREATEST_TX))
def _(d):
    lake = silver_lake(d)
    return content(SILVER_SPECS, "target", lambda spec: layers.read_silver(d.spark, lake, spec))


@query("flow03_silver_increment", sql(
    "SELECT table_name, run_id, row_count FROM (SELECT 'fact_order_transactions' AS table_name, run_id, row_count "
    "FROM (SELECT 'lot-F' AS run_id, count(DISTINCT order_id) AS row_count FROM tx WHERE line_status = 'F' "
    "UNION ALL SELECT 'lot-O', count(DISTINCT order_id) FROM tx WHERE line_status = 'O' UNION ALL SELECT 'nothing-new', 0))"))
def _(d):
    lake = new_lake(d)
    spec = model.TRANSACTIONS
    for run_id in ("lot-F", "lot-O", "nothing-new"):
        if run_id != "nothing-new":
            lot = d.transactions.filter(F.col("line_status") == run_id[-1]).select(*spec.columns)
            drop_csv(lot, f"{lake.layer('raw')}/{spec.source}")
        layers.ingest_incremental(d.spark, lake, [spec], run_id=run_id)
        layers.build_silver(d.spark, lake, [spec], run_id=run_id)
    log = tables.read_table(d.spark, lake.table("ops", "etl_audit_log")).where("task_name = 'build_silver'")
    return log.select(F.lit(spec.target).alias("table_name"), "run_id", "row_count")


@query("flow12_lake_to_gold", sql(
    "SELECT priority_rank, sku, decision, action_type, stock_cover_hrs FROM rankd"))
def _(d):
    lake = silver_lake(d)
    gold.build_gold(d.spark, lake, run_id="run-1", run_at=RUN_AT, view="vw_low_stock_of_lake")
    rows = tables.read_table(d.spark, lake.table("gold", "product_pushnow_current"))
    return rows.select("priority_rank", "sku", "decision", "action_type", "stock_cover_hrs")


@query("flow11_maintenance", sql(
    "SELECT sku, product_name, scheduled_restock_timestamp, restock_units, status FROM rst"))
def _(d):
    lake = new_lake(d)
    target = lake.table("silver", model.RESTOCK.target)
    tables.replace_table(d.restock.repartition(16), target)
    tables.replace_table(d.product.repartition(16), lake.table("gold", "board"))
    layers.maintain(d.spark, lake, [model.RESTOCK], ["board"])
    return harmonize_numbers(tables.read_table(d.spark, target))
