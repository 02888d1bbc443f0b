"""Bronze ingest, silver build and table maintenance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchtide.model import REGISTRY, TableSpec
from merchtide.plans.silver import load_silver
from merchtide.sources import bronze, storage, tables
from merchtide.sources.audit import audited
from merchtide.sources.files import read_source, with_lineage
from merchtide.streaming.ingest import schema_path, take_new_files


@dataclass(frozen=True)
class Lake:
    """Folders of one deployment."""

    root: str

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"


def ingest_batch(
    spark: SparkSession, lake: Lake, specs: Sequence[TableSpec] = REGISTRY,
    run_id: str | None = None, multi_line: bool = False,
) -> dict[str, int]:
    """Load every source's files as one drop of its bronze table; stop at the first failure.

    The drop is named by the run, so a run that is repeated adds nothing.
    """
    run_id = run_id or str(uuid4())
    counts = {}
    for spec in specs:
        target = lake.table("bronze", f"raw_{spec.source}")
        log = lake.table("ops", "etl_audit_log")
        with audited(spark, log, run_id, "ingest_bronze_batch", target) as outcome:
            rows = read_source(spark, lake.layer("raw"), spec, multi_line=multi_line, misfits=True)
            outcome["row_count"] = bronze.write_drop(
                with_lineage(rows, spec.source), target, schema_path(lake.layer("checkpoints"), spec), run_id)
        counts[spec.source] = outcome["row_count"]
    return counts


def ingest_incremental(
    spark: SparkSession, lake: Lake, specs: Sequence[TableSpec] = REGISTRY,
    run_id: str | None = None, multi_line: bool = False,
) -> None:
    run_id = run_id or str(uuid4())
    for spec in specs:
        target = lake.table("bronze", f"raw_{spec.source}")
        log = lake.table("ops", "etl_audit_log")
        with audited(spark, log, run_id, "ingest_bronze_stream", target) as outcome:
            outcome["row_count"] = take_new_files(
                spark, lake.layer("raw"), lake.layer("bronze"), lake.layer("checkpoints"), spec,
                multi_line,
            )
            outcome["message"] = "all available files taken"


LOADS = "silver_loads"
LOADS_DDL = "table_name string, drop_name string, run_id string"


def drops_to_load(spark: SparkSession, lake: Lake, spec: TableSpec) -> list[str]:
    """Drops of the source that no build has loaded into its silver table yet."""
    found = bronze.drops(spark, lake.table("bronze", f"raw_{spec.source}"))
    log = lake.table("ops", LOADS)
    if not storage.exists(spark, log):
        return found
    rows = spark.read.schema(LOADS_DDL).parquet(log).where(F.col("table_name") == spec.target)
    # A row per drop, as the listing of the folders is.
    done = {r["drop_name"] for r in rows.select("drop_name").distinct().collect()}
    return [name for name in found if name not in done]


def build_silver(
    spark: SparkSession, lake: Lake, specs: Sequence[TableSpec] = REGISTRY,
    run_id: str | None = None, full: bool = False,
) -> dict[str, int]:
    """Type, check, deduplicate and upsert the bronze drops not loaded before, of every table.

    Failed checks are recorded and do not stop the load; rows that do not fit go to
    quarantine. A drop counts as loaded when its rows are in silver; one that is loaded
    again after a failure changes nothing, as rows replace themselves by key. ``full``
    loads all drops again.
    """
    run_id = run_id or str(uuid4())
    counts = {}
    for spec in specs:
        source = lake.table("bronze", f"raw_{spec.source}")
        if full and storage.exists(spark, source):
            names = bronze.drops(spark, source)
        else:
            names = drops_to_load(spark, lake, spec)
        if not names:
            with audited(spark, lake.table("ops", "etl_audit_log"), run_id, "build_silver",
                         lake.table("silver", spec.target)) as outcome:
                outcome.update(row_count=0, message="no new drops")
            counts[spec.target] = 0
            continue
        rows = bronze.read_bronze(spark, source, spec, names=names)
        size = sum(storage.total_bytes(spark, f"{source}/{bronze.DROP}={name}") for name in names)
        counts[spec.target] = load_silver(
            rows, spec, lake.layer("silver"), lake.layer("ops"), run_id, size=size)
        loads = spark.createDataFrame([(spec.target, name, run_id) for name in names], LOADS_DDL)
        tables.append_typed(loads.coalesce(1), lake.table("ops", LOADS), LOADS_DDL)
    return counts


def read_silver(spark: SparkSession, lake: Lake, spec: TableSpec) -> DataFrame:
    """A silver table by its declared schema, so that no file is opened to learn it."""
    rows = tables.read_table(spark, lake.table("silver", spec.target), spec.silver_schema)
    return rows.select(*spec.silver_schema.names)


def maintain(
    spark: SparkSession, lake: Lake, specs: Sequence[TableSpec] = REGISTRY,
    gold: Sequence[str] = (),
) -> dict[str, str]:
    """Cluster the snapshot silver tables and compact the gold tables.

    A table that cannot be compacted is reported and does not stop the others;
    partitioned tables are already written in sized files per partition.
    """
    report = {}
    jobs = [("silver", s.target, s.cluster_by) for s in specs if not s.partition_by]
    jobs += [("gold", name, ()) for name in gold]
    for layer, name, cluster_by in jobs:
        try:
            files = tables.compact_table(spark, lake.table(layer, name), cluster_by)
            report[name] = f"{files} files"
        except Exception as error:  # noqa: BLE001 - the report carries it
            report[name] = f"failed: {error}"
    return report
