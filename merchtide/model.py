"""Table specifications, quality rules and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LINEAGE_COLUMNS = ("_source_name", "_ingested_at", "_input_file_name")
STAMP_COLUMN = "_silver_processed_at"


@dataclass(frozen=True)
class TableSpec:
    """One registry entry: a raw source and the silver table it feeds."""

    source: str
    target: str
    keys: tuple[str, ...]
    ddl: str
    cluster_by: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] | None = None

    @property
    def source_file(self) -> str:
        return f"{self.source}.csv"

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in self.schema}

    @property
    def raw_schema(self) -> T.StructType:
        """Every column as text, the way files arrive."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.schema])

    @property
    def silver_schema(self) -> T.StructType:
        """The columns of the silver table: declared ones, lineage and the stamp."""
        source, at, file = LINEAGE_COLUMNS
        return T.StructType([*self.schema, *T.StructType.fromDDL(
            f"{source} string, {at} timestamp, {file} string, {STAMP_COLUMN} timestamp")])

    @property
    def required(self) -> tuple[str, ...]:
        """Columns checked for NULL; the key where no list is declared."""
        return self.keys if self.not_null is None else self.not_null

    @property
    def non_negative(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c in NON_NEGATIVE)


# Measures that may never be below zero, in any table.
NON_NEGATIVE = (
    "sessions", "clicks", "orders", "units_sold",
    "gross_revenue", "ad_spend", "closing_stock", "opening_stock",
)

PRODUCT = TableSpec(
    source="product_master",
    target="dim_product",
    keys=("sku",),
    ddl="sku string, product_name string, category string, brand string, "
        "unit_price decimal(12,2), margin_pct decimal(6,2), base_stock int, "
        "initial_stock_cover_hrs decimal(8,2)",
    cluster_by=("sku", "category"),
    not_null=("sku", "product_name", "category"),
)

MARKETING = TableSpec(
    source="marketing_performance_hourly",
    target="fact_marketing_performance_hourly",
    keys=("hour_key", "sku"),
    ddl="timestamp timestamp, hour_key string, sku string, product_name string, category string, "
        "sessions int, clicks int, ctr_pct decimal(8,2), orders int, units_sold int, "
        "cvr_pct decimal(8,2), gross_revenue decimal(14,2), ad_spend decimal(14,2), "
        "roas decimal(8,2), demand_index decimal(8,2), demand_spike_pct decimal(8,2), "
        "discount_pct decimal(6,2), avg_dwell_time_sec int, push_score decimal(8,2)",
    cluster_by=("sku", "category", "timestamp"),
    partition_by=("hour_key",),
    not_null=("hour_key", "sku", "timestamp"),
)

STOCK = TableSpec(
    source="stock_movement_hourly",
    target="fact_stock_movement_hourly",
    keys=("hour_key", "sku"),
    ddl="timestamp timestamp, hour_key string, sku string, product_name string, category string, "
        "opening_stock int, units_sold int, restocked_units int, closing_stock int, "
        "stock_cover_hrs decimal(8,2), stock_risk_flag string",
    cluster_by=("sku", "stock_risk_flag"),
    partition_by=("hour_key",),
    not_null=("hour_key", "sku", "timestamp"),
)

TRANSACTIONS = TableSpec(
    source="order_transactions",
    target="fact_order_transactions",
    keys=("order_id",),
    ddl="order_id string, order_timestamp timestamp, sku string, product_name string, "
        "category string, quantity int, order_value decimal(14,2), discount_pct decimal(6,2), "
        "traffic_channel string, city string, customer_type string, payment_mode string",
    cluster_by=("sku", "order_timestamp", "traffic_channel"),
    partition_by=("category",),
    not_null=("order_id", "order_timestamp", "sku"),
)

# The three summaries have a row, or one per category or channel, an hour: ten years are a
# few hundred thousand rows, too few for folders of their own.
ORDERS_HOURLY = TableSpec(
    source="orders_hourly_summary",
    target="fact_orders_hourly_summary",
    keys=("hour_key",),
    ddl="timestamp timestamp, hour_key string, total_orders int, total_units int, "
        "total_sessions int, revenue decimal(14,2), ad_spend decimal(14,2), "
        "conversion_rate_pct decimal(8,2), aov decimal(12,2)",
    cluster_by=("timestamp",),
)

CATEGORY_HOURLY = TableSpec(
    source="category_performance_hourly",
    target="fact_category_performance_hourly",
    keys=("hour_key", "category"),
    ddl="timestamp timestamp, hour_key string, category string, sessions int, orders int, "
        "revenue decimal(14,2), ad_spend decimal(14,2), avg_demand_spike_pct decimal(8,2), "
        "avg_push_score decimal(8,2), cvr_pct decimal(8,2), roas decimal(8,2)",
    cluster_by=("category",),
)

CHANNEL_HOURLY = TableSpec(
    source="channel_performance_hourly",
    target="fact_channel_performance_hourly",
    keys=("hour_key", "channel"),
    ddl="timestamp timestamp, hour_key string, channel string, sessions int, orders int, "
        "revenue decimal(14,2), ad_spend decimal(14,2), cvr_pct decimal(8,2), roas decimal(8,2)",
    cluster_by=("channel",),
)

RESTOCK = TableSpec(
    source="restock_schedule",
    target="fact_restock_schedule",
    keys=("sku", "scheduled_restock_timestamp"),
    ddl="sku string, product_name string, scheduled_restock_timestamp timestamp, "
        "restock_units int, status string",
    cluster_by=("sku", "scheduled_restock_timestamp"),
)

REGISTRY = (
    PRODUCT, MARKETING, STOCK, TRANSACTIONS,
    ORDERS_HOURLY, CATEGORY_HOURLY, CHANNEL_HOURLY, RESTOCK,
)


@dataclass(frozen=True)
class Thresholds:
    """Business rules of the decision ladder."""

    stock_low_hrs: float = 12.0
    stock_medium_hrs: float = 18.0
    min_push_roas: float = 5.0
    min_push_cvr: float = 4.5
    profit_margin: float = 45.0
    action_limit: int = 5


# Labels that appear in the decision tables.
PUSH_NOW = "PUSH_NOW_PAID_AND_OWNED"
PUSH_LOW_STOCK = "PROMOTE_CAREFULLY_LOW_STOCK"
PUSH_PROFIT = "PUSH_HIGH_INTENT_PROFIT"
PUSH_SECONDARY = "SECONDARY_PUSH"
CHANNEL_SEQUENCES = {
    "Push Now": "Homepage Tile → App Push → Search Boost → Retargeting",
    "Guarded Push": "Retargeting Only → Frequency Cap → Await Restock",
    "Secondary Push": "Category Placement → Search Boost → Retargeting",
}
BUDGET_SHIFTS = {"Push Now": 12.0, "Secondary Push": 5.0, "Guarded Push": 0.0}

# Schemas of the operations tables.
AUDIT_DDL = (
    "run_id string, task_name string, table_name string, status string, row_count bigint, "
    "message string, started_at timestamp, ended_at timestamp"
)
QUALITY_DDL = (
    "run_id string, layer string, table_name string, rule_name string, rule_status string, "
    "failed_count bigint, checked_at timestamp"
)
BATCH_REGISTRY_DDL = (
    "batch_id string, business_domain string, criticality string, "
    "expected_data_available_minute int, sla_offset_minutes int, owner_team string, "
    "escalation_team string, active_flag boolean, processes array<string>"
)
RUNTIME_EVENT_DDL = (
    "event_id string, batch_id string, event_time timestamp, data_available_time timestamp, "
    "actual_start_time timestamp, current_status string, current_process string, "
    "current_resource string, process_status string, process_delay_min double, "
    "message string, created_at timestamp"
)
KNOWLEDGE_DDL = (
    "kb_id string, process string, resource string, symptoms array<string>, "
    "likely_root_causes array<string>, mitigations array<string>, "
    "resources_to_check array<string>, escalation_team string"
)


@dataclass(frozen=True)
class History:
    """Duration history assumed for a batch that has no recorded run."""

    avg: float
    p95: float
    misses: int
    p90: float
    success: float


# The record used when a batch is unknown, and the records
# assumed by a part of the batch name when there are no events at all.
UNKNOWN_HISTORY = History(avg=30.0, p90=40.0, p95=45.0, success=95.0, misses=0)
ASSUMED_HISTORY = {
    "STOCK": History(avg=47.5, p90=52.0, p95=54.0, success=96.0, misses=5),
    "MARKETING": History(avg=30.3, p90=33.0, p95=35.0, success=96.0, misses=1),
    "ORDERS": History(avg=35.3, p90=40.0, p95=42.0, success=96.0, misses=2),
    "": History(avg=28.0, p90=36.0, p95=38.0, success=96.0, misses=1),
}

# The known processes and the resource each one leans on.
PROCESS_RESOURCES = {
    "raw_file_arrival": "landing_zone",
    "bronze_ingestion": "ingest_cluster",
    "silver_transformation": "transform_cluster",
    "gold_aggregation": "gold_tables",
    "dashboard_refresh": "query_service",
    "stock_reconciliation": "inventory_feed",
    "gold_pushnow_scoring": "scoring_job",
    "campaign_metrics_join": "campaign_feed",
    "gold_budget_shift": "budget_table",
}

# Texts that appear in the recommendations.
NOTIFY_ACTION = "Notify batch owner and SLA operations channel immediately."
PRIORITIZE_ACTION = "Prioritize this batch over non-critical downstream workloads."
NO_CONTEXT = (
    "No specific runbook found. Default to checking cluster execution limits "
    "and Delta table optimization logs."
)


@dataclass(frozen=True)
class KnowledgeEntry:
    kb_id: str
    process: str
    resource: str
    symptoms: tuple[str, ...]
    likely_root_causes: tuple[str, ...]
    mitigations: tuple[str, ...]
    resources_to_check: tuple[str, ...]
    escalation_team: str = field(default="Data Platform")


# Our own starter knowledge base; a deployment loads its own from JSON.
STARTER_KNOWLEDGE = (
    KnowledgeEntry(
        "KB01", "raw_file_arrival", "landing zone",
        ("drop folder stays empty past the hour", "file shorter than usual"),
        ("upstream export has not finished", "transfer credentials expired"),
        ("ask the upstream owner for an estimate", "rerun the transfer", "load the last good file"),
        ("transfer log", "landing folder listing"),
    ),
    KnowledgeEntry(
        "KB02", "bronze_ingestion", "ingest cluster",
        ("ingest task runs twice its usual time", "many tiny files listed"),
        ("file count has grown", "executors were lost"),
        ("compact the landing folder", "add ingest executors", "replay from the checkpoint"),
        ("stream progress", "executor log"),
    ),
    KnowledgeEntry(
        "KB03", "silver_transformation", "spark cluster",
        ("one long straggler task", "shuffle spill to disk"),
        ("one key holds most rows", "upsert touches every partition"),
        ("split the hot key", "limit the upsert to touched partitions", "raise shuffle partitions"),
        ("stage timeline", "partition sizes"),
    ),
    KnowledgeEntry(
        "KB04", "gold_aggregation", "gold tables",
        ("hourly totals arrive late", "dashboard shows the previous hour"),
        ("silver finished late", "gold files are fragmented"),
        ("rerun the hourly totals", "compact the gold tables"),
        ("gold table files", "audit log"),
    ),
    KnowledgeEntry(
        "KB05", "stock_reconciliation", "inventory source",
        ("closing stock disagrees with the count", "stock rows missing for the hour"),
        ("inventory source throttles requests", "restock message delivered twice"),
        ("replay the missing stock hours", "lower the request rate", "drop repeated restock messages"),
        ("inventory source status", "restock feed"),
    ),
    KnowledgeEntry(
        "KB06", "gold_pushnow_scoring", "scoring job",
        ("push list is empty", "scores are all equal"),
        ("marketing and stock hours do not line up", "margin data is stale"),
        ("align the snapshot hours", "refresh product margins"),
        ("snapshot hour of each input", "product load time"),
    ),
    KnowledgeEntry(
        "KB07", "campaign_metrics_join", "campaign source",
        ("ad spend is zero for a channel", "campaign join drops rows"),
        ("campaign export delayed", "campaign keys changed"),
        ("reload campaign spend", "map the new campaign keys"),
        ("campaign export log", "unmatched key count"),
    ),
)
