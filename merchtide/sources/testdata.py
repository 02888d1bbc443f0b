"""Silver-shaped frames derived from the TPC-H-like test tables.

Every frame is built from whole tables and grows with them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchtide.functions import clock as ck
from merchtide.functions import metrics as mt
from merchtide.functions.numeric import fixed_sum, ratio, rounded
from merchtide.operators.ledger import stock_ledger

# The processes an event can name; the last two places name none.
EVENT_PROCESSES = (
    "raw_file_arrival", "bronze_ingestion", "silver_transformation", "gold_aggregation",
    "dashboard_refresh", "stock_reconciliation", "gold_pushnow_scoring", "campaign_metrics_join",
    None, None,
)
# The process lists a batch can have.
BATCH_PROCESSES = (
    ("raw_file_arrival", "bronze_ingestion", "silver_transformation"),
    ("raw_file_arrival", "bronze_ingestion", "stock_reconciliation", "silver_transformation",
     "gold_pushnow_scoring"),
    ("campaign_metrics_join", "silver_transformation", "gold_budget_shift", "audit_export"),
)


# Table schemas already read, so a footer is opened once per file and session.
_schemas: dict[str, T.StructType] = {}


@dataclass
class TestData:
    """``grain`` is the width of a marketing and stock slot."""

    spark: SparkSession
    folder: str
    grain: str = "day"

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    @cached_property
    def clock(self) -> Column:
        """Newest marketing slot, from the event times alone."""
        newest = self.raw("events").agg(ck.truncated(F.max("ts"), self.grain).alias("t"))
        return newest.scalar()

    @cached_property
    def product(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            F.concat(F.lit("P"), key).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("unit_price"),
            (F.lit(20) + F.col("p_size")).cast("double").alias("margin_pct"),
            ((F.lit(4) + key % 37) * 4).cast("int").alias("base_stock"),
            (F.lit(6) + F.col("p_size") % 25).cast("double").alias("initial_stock_cover_hrs"),
        )

    @cached_property
    def activity(self) -> DataFrame:
        """Events counted per slot and product; one row per (slot, product)."""
        kind = F.col("event_type")
        counts = (
            self.raw("events")
            .select(
                ck.truncated(F.col("ts"), self.grain).alias("timestamp"),
                F.concat(F.lit("P"), "user_id").alias("sku"),
                kind, "value",
            )
            .groupBy("timestamp", "sku")
            .agg(
                (F.count("*") * 10).alias("sessions"),
                F.count_if(kind == "click").alias("clicks"),
                F.count_if(kind == "purchase").alias("orders"),
                F.count_if(kind == "signup").alias("signups"),
                F.coalesce(
                    fixed_sum(F.when(kind == "purchase", F.col("value"))), F.lit(0.0)
                ).alias("gross_revenue"),
                F.coalesce(
                    fixed_sum(F.when(kind == "click", F.col("value"))), F.lit(0.0)
                ).alias("ad_spend"),
            )
        )
        return counts.withColumn("units_sold", F.col("orders") * 2 + F.col("signups"))

    def _slot(self) -> Column:
        """The place of a slot in its cycle: at most 24 values."""
        return F.dayofweek("timestamp") if self.grain == "day" else F.hour("timestamp")

    @cached_property
    def slot_means(self) -> DataFrame:
        """Usual units per place in the cycle."""
        return (
            self.activity.groupBy(self._slot().alias("slot"))
            .agg(F.sum("units_sold").alias("_u"), F.count("*").alias("_n"))
            .select("slot", ratio(F.col("_u"), F.col("_n")).alias("usual_units"))
        )

    @cached_property
    def marketing(self) -> DataFrame:
        c = F.col
        # Usual units: a handful of rows by construction (7 weekdays or 24 hours).
        rows = self.activity.withColumn("slot", self._slot()).join(
            F.broadcast(self.slot_means), "slot"
        )
        measured = rows.select(
            "timestamp",
            ck.hour_key(c("timestamp")).alias("hour_key"),
            "sku", "sessions", "clicks",
            mt.percent(c("clicks"), c("sessions")).alias("ctr_pct"),
            "orders", "units_sold",
            mt.percent(c("orders"), c("sessions")).alias("cvr_pct"),
            "gross_revenue", "ad_spend",
            mt.roas(c("gross_revenue"), c("ad_spend")).alias("roas"),
            mt.demand_index(c("units_sold"), c("usual_units")).alias("demand_index"),
            F.least(F.lit(12.0), c("signups") * 1.5).alias("discount_pct"),
            (F.lit(40) + c("sessions") % 50).alias("avg_dwell_time_sec"),
        ).withColumn(
            "demand_spike_pct", rounded(F.greatest(F.lit(0.0), c("demand_index") - 100.0), 1)
        )
        named = measured.join(
            self.product.select("sku", "product_name", "category", "margin_pct"), "sku"
        )
        return named.select(
            "timestamp", "hour_key", "sku", "product_name", "category", "sessions", "clicks",
            "ctr_pct", "orders", "units_sold", "cvr_pct", "gross_revenue", "ad_spend", "roas",
            "demand_index", "demand_spike_pct", "discount_pct", "avg_dwell_time_sec",
            mt.push_score(
                c("demand_spike_pct"), c("roas"), c("cvr_pct"), c("margin_pct"), c("ctr_pct")
            ).alias("push_score"),
        )

    @cached_property
    def moves(self) -> DataFrame:
        """Stock movements: units asked for, and six pieces back after a signup."""
        base = self.product.select("sku", "base_stock")
        return self.activity.select(
            "timestamp", "sku", F.col("units_sold").alias("units"),
            F.when(F.col("signups") > 0, 6).otherwise(0).alias("restock"),
        ).join(base, "sku")

    def ledger(self, rule: str = "sell_available") -> DataFrame:
        return stock_ledger(self.moves, rule)

    @cached_property
    def stock(self) -> DataFrame:
        cover = mt.stock_cover(F.col("closing_stock"), F.col("units_sold"))
        return (
            self.ledger()
            .join(self.product.select("sku", "product_name", "category"), "sku")
            .withColumn("stock_cover_hrs", cover)
            .select(
                "timestamp", ck.hour_key(F.col("timestamp")).alias("hour_key"), "sku",
                "product_name", "category", "opening_stock", "units_sold", "restocked_units",
                "closing_stock", "stock_cover_hrs",
                mt.stock_risk(F.col("stock_cover_hrs")).alias("stock_risk_flag"),
            )
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """Order lines; (order, line) repeats in the data, so order ids repeat too."""
        c = F.col
        # Orders meet their customers before their lines, so that lines are shuffled twice, not three times.
        buyers = self.raw("customer").join(self.raw("nation"), c("c_nationkey") == c("n_nationkey"))
        orders = self.raw("orders").join(buyers, c("o_custkey") == c("c_custkey"))
        lines = (
            self.raw("lineitem")
            .join(orders, c("l_orderkey") == c("o_orderkey"))
            .join(self.raw("part"), c("l_partkey") == c("p_partkey"))
        )
        discount = rounded(c("l_discount") * 100.0, 1)
        return lines.select(
            F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("order_id"),
            c("o_orderdate").cast("timestamp_ntz").alias("order_timestamp"),
            F.concat(F.lit("P"), "l_partkey").alias("sku"),
            c("p_name").alias("product_name"),
            c("p_type").alias("category"),
            c("l_quantity").cast("int").alias("quantity"),
            mt.order_value(c("p_retailprice"), c("l_quantity"), discount).alias("order_value"),
            discount.alias("discount_pct"),
            c("o_orderpriority").alias("traffic_channel"),
            c("n_name").alias("city"),
            c("c_mktsegment").alias("customer_type"),
            c("l_returnflag").alias("payment_mode"),
            c("l_shipdate").cast("timestamp_ntz").alias("shipped_at"),
            c("l_linestatus").alias("line_status"),
        )

    @cached_property
    def channel(self) -> DataFrame:
        """Orders per quarter and priority, priority standing for the channel."""
        c = F.col
        sums = (
            self.raw("orders")
            .groupBy(
                ck.truncated(c("o_orderdate"), "quarter").alias("timestamp"),
                c("o_orderpriority").alias("channel"),
            )
            .agg(
                (F.count("*") * 20).alias("sessions"),
                F.count("*").alias("orders"),
                fixed_sum(c("o_totalprice")).alias("revenue"),
                F.coalesce(
                    fixed_sum(F.when(c("o_orderstatus") == "F", c("o_totalprice"))), F.lit(0.0)
                ).alias("ad_spend"),
            )
        )
        return sums.select(
            "timestamp", ck.hour_key(c("timestamp")).alias("hour_key"), "channel", "sessions",
            "orders", "revenue", "ad_spend",
            rounded(mt.floored_ratio(c("orders"), c("sessions")) * 100.0, 2).alias("cvr_pct"),
            rounded(mt.floored_ratio(c("revenue"), c("ad_spend")), 2).alias("roas"),
        )

    @cached_property
    def restock(self) -> DataFrame:
        start = F.lit("2024-02-01").cast("timestamp_ntz")
        return self.product.select(
            "sku", "product_name",
            F.timestamp_add("DAY", F.substring("sku", 2, 20).cast("int") % 30, start)
            .alias("scheduled_restock_timestamp"),
            (F.col("base_stock") * 10).alias("restock_units"),
            F.lit("Planned").alias("status"),
        )

    # --- batch risk -------------------------------------------------------

    @cached_property
    def batches(self) -> DataFrame:
        """One scheduled batch per customer; some inactive, some without a flag."""
        key, balance = F.col("c_custkey"), F.col("c_acctbal")
        lists = F.array(*[F.array(*[F.lit(p) for p in ps]) for ps in BATCH_PROCESSES])
        return self.raw("customer").select(
            F.concat(F.lit("B"), key).alias("batch_id"),
            F.col("c_mktsegment").alias("business_domain"),
            F.when(balance >= 5000, "HIGH").otherwise("MEDIUM").alias("criticality"),
            (key % 15).cast("int").alias("expected_data_available_minute"),
            (F.lit(40) + key % 30).cast("int").alias("sla_offset_minutes"),
            F.concat(F.lit("Team "), "c_nationkey").alias("owner_team"),
            F.lit("Data Platform").alias("escalation_team"),
            F.when(balance < 0, F.lit(False)).when(F.col("c_nationkey") != 7, F.lit(True))
            .alias("active_flag"),
            lists[(key % len(BATCH_PROCESSES)).cast("int")].alias("processes"),
        )

    @cached_property
    def runtime_events(self) -> DataFrame:
        """One runtime event per event; a run is one batch in one hour."""
        kind = F.col("event_type")
        names = F.array(*[F.lit(p) for p in EVENT_PROCESSES])
        hour = ck.truncated(F.col("ts"), "hour")
        process = names[(F.col("event_id") % len(EVENT_PROCESSES)).cast("int")]
        return self.raw("events").select(
            "event_id",
            F.concat(F.lit("B"), "user_id").alias("batch_id"),
            F.col("ts").alias("event_time"),
            F.timestamp_add("MINUTE", F.lit(-4), hour).alias("data_available_time"),
            hour.alias("actual_start_time"),
            F.lit("RUNNING").alias("current_status"),
            process.alias("current_process"),
            F.concat(F.lit("node_"), kind).alias("current_resource"),
            F.when(kind == "error", "DEGRADED").when(kind != "view", "HEALTHY")
            .alias("process_status"),
            (F.col("value") / 25.0).alias("process_delay_min"),
            F.concat_ws(" ", process, F.lit("reported"), kind).alias("message"),
        )

    @cached_property
    def run_clock(self) -> Column:
        """Half past the newest event hour."""
        newest = self.raw("events").agg(
            F.timestamp_add("MINUTE", F.lit(30), ck.truncated(F.max("ts"), "hour")).alias("t")
        )
        return newest.scalar()

    @cached_property
    def benchmark_kb(self) -> DataFrame:
        return self.raw("benchmark").select("item_id", "text")
