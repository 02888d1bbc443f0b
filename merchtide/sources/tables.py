"""Tables kept as files: snapshots, upserts, partitions, compaction and views.

A snapshot table is a folder of numbered versions. A reader takes the newest
complete version, a writer adds the next one, so a failed write leaves the old
rows in place and readers never see half a table. A table with partition columns
is one folder that is changed partition by partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchtide.operators.upsert import upsert
from merchtide.sources import storage

FORMAT = "parquet"
TARGET_FILE_BYTES = 256 * 1024 * 1024
# What one task sorts at most when a table is clustered, in bytes in memory; files can be much smaller.
SORT_BYTES = 512 * 1024 * 1024
# Fixed value: how Spark names the folder of the NULL partition.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def versions(spark: SparkSession, path: str) -> list[str]:
    names = [n for n in storage.child_names(spark, path) if n.startswith("v0")]
    return [n for n in names if storage.exists(spark, f"{path}/{n}/_SUCCESS")]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a complete version, or for a plain folder with visible content."""
    names = storage.child_names(spark, path)
    plain = [n for n in names if n[0] not in "._" and not n.startswith("v0")]
    return bool(plain) or bool(versions(spark, path))


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's rows now."""
    found = versions(spark, path)
    return f"{path}/{found[-1]}" if found else path


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    merge: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Scan a table; ``merge`` unites the columns of files written over time.

    Values of the ``partition_by`` columns come from folder names and are read
    as text, without guessing numbers, so 007 stays 007.
    """
    here = current_path(spark, path)
    reader = spark.read.format(FORMAT).option("mergeSchema", merge)
    if schema is None and partition_by:
        guessed = reader.load(here).schema
        schema = T.StructType([
            T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in guessed
        ])
    return (reader.schema(schema) if schema is not None else reader).load(here)


def replace_table(df: DataFrame, path: str, keep: int = 2) -> int:
    """Write the next version of a snapshot table and return its row count.

    The rows are counted while they are written.
    """
    spark = df.sparkSession
    found = versions(spark, path)
    number = int(found[-1][1:]) + 1 if found else 1
    version = f"v{number:08d}"
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    with storage.last_use(spark):
        counted.write.format(FORMAT).mode("overwrite").save(f"{path}/{version}")
    if spark.catalog.tableExists(rows_view(path)):
        _point_view(spark, path)
    for old in found[: max(0, len(found) + 1 - keep)]:
        storage.remove(spark, f"{path}/{old}")
    return counter.get["rows"]


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """The greatest value of the first partition column, by the names of the folders."""
    names = storage.child_names(spark, path)
    values = [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=")]
    return max((v for v in values if v != NULL_FOLDER), default=None)


def append_rows(df: DataFrame, path: str) -> int:
    """Append to a plain folder, new columns allowed, and return the row count."""
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    with storage.last_use(df.sparkSession):
        counted.write.format(FORMAT).mode("append").save(path)
    return counter.get["rows"]


def append_typed(df: DataFrame, path: str, ddl: str) -> int:
    """Append to an operations table after fixing columns, order and types."""
    schema = T.StructType.fromDDL(ddl)
    typed = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return append_rows(df.select(*typed), path)


def upsert_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    more: Sequence[DataFrame] = (),
) -> int:
    """Update matching rows, insert the others, return the number of source rows.

    By key, so applying the same rows again changes nothing. ``more`` are further lots of
    source rows, with other keys; each is computed after the one before.
    """
    spark = source.sparkSession
    source = storage.stage(source, "upsert-source", *more)
    if partition_by:
        _upsert_partitions(source, path, list(keys), list(partition_by))
    elif table_exists(spark, path):
        replace_table(upsert(read_table(spark, path), source, keys), path)
    else:
        replace_table(source, path)
    return source.count()


def _upsert_partitions(source: DataFrame, path: str, keys: list[str], by: list[str]) -> None:
    """Rewrite only the partitions an upsert touches.

    Those are the partitions of the source rows and, where a row may move, the
    partitions of the target rows it replaces. The new content is staged before
    it is published: the published files are never read and overwritten in one
    job, and a broken publish can be repeated.
    """
    spark = source.sparkSession
    if not table_exists(spark, path):
        write_partitioned(source, path, by, storage.lots_of(storage.staged_bytes(source)))
        return
    target = read_table(spark, path, merge=True, partition_by=by)
    # Partition values come back as text, so their types are restated.
    kinds = {f.name: f.dataType for f in source.schema}
    target = target.select(
        *[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in target.columns]
    )
    touched = source.select(*by).distinct()
    if not set(by) <= set(keys):
        moved = target.join(source.select(*keys), keys, "left_semi").select(*by).distinct()
        touched = touched.union(moved).distinct()
    touched = storage.stage(touched, "touched")
    merged = storage.stage(upsert(_within(target, touched, by), source, keys), "upsert-merged")
    write_partitioned(merged, path, by, storage.lots_of(storage.staged_bytes(merged)))
    _drop_emptied(touched, merged, path, by)


def _within(target: DataFrame, touched: DataFrame, by: list[str]) -> DataFrame:
    """Target rows of the touched partitions.

    The filter reads the partition columns only, so it prunes folders when the query runs.
    Its list holds a value per touched partition, as the scan's own list of folders does.
    """
    wanted = touched.agg(F.collect_list(F.struct(*by))).scalar()
    return target.filter(F.array_contains(wanted, F.struct(*by)))


def _drop_emptied(touched: DataFrame, merged: DataFrame, path: str, by: list[str]) -> None:
    """Remove folders of partitions whose rows have all moved elsewhere."""
    spark = touched.sparkSession
    left = merged.select(*by).distinct()
    renamed = left.toDF(*[f"_t_{c}" for c in by])
    same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in by]
    for row in touched.join(renamed, same, "left_anti").toLocalIterator():
        folder = "/".join(
            spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
            .getPartitionPathString(c, None if row[c] is None else str(row[c]))
            for c in by
        )
        storage.remove(spark, f"{path}/{folder}")


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], lots: int = 1) -> None:
    """Write folders per partition value, replacing only the partitions in ``df``.

    The rebalance gathers small partition values in few files and splits a value
    that holds much of the table over many tasks, by the sizes seen at run time.
    ``df`` is read once for each of the ``lots`` its partitions are written in.
    """
    for lot in storage.lots(df, by, lots):
        with storage.last_use(df.sparkSession):
            (
                lot.hint("rebalance", *[F.col(c) for c in by])
                .write.format(FORMAT)
                .mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*by)
                .save(path)
            )


def _held_bytes(rows: DataFrame) -> int:
    """About what the rows take while they are sorted: a word a value, the texts, a sort entry a row."""
    size = F.lit(8 * len(rows.columns) + 64)
    for f in rows.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size += F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0))
    return rows.agg(F.sum(size)).first()[0] or 0


def compact_table(
    spark: SparkSession,
    path: str,
    cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite a snapshot table into few files, clustered where columns are given.

    Files hold neighbouring cluster values, so the minimum and maximum kept per
    file skip most of them. The row's old place ends the sort key: equal cluster
    values can be cut between files, however many rows share them. A file is sorted
    by one task, so rows that pack well are cut into more files, by ``SORT_BYTES``.
    Returns the number of files asked for.
    """
    here = current_path(spark, path)
    files = max(1, -(-storage.total_bytes(spark, here) // target_bytes))
    rows = read_table(spark, path)
    if cluster_by:
        files = max(files, -(-_held_bytes(rows) // SORT_BYTES))
        keys = [*cluster_by, "_place"]
        rows = (
            rows.withColumn("_place", F.monotonically_increasing_id())
            .repartitionByRange(files, *keys)
            .sortWithinPartitions(*keys)
            .drop("_place")
        )
    else:
        rows = rows.repartition(files)
    replace_table(rows, path)
    return files


def rows_view(path: str) -> str:
    """Name of the view over the newest version of a table that somebody has published."""
    return f"rows_{md5(path.encode()).hexdigest()}"


def _point_view(spark: SparkSession, path: str) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {rows_view(path)} AS "
        f"SELECT * FROM {FORMAT}.`{current_path(spark, path)}`")


def publish_view(
    spark: SparkSession, name: str, path: str, columns: Sequence[str], condition: str
) -> str:
    """A persistent view over the table that follows its rewrites.

    It selects from a view of all the table's rows, which each later ``replace_table``
    points to the version it has written, before old versions are removed.
    """
    _point_view(spark, path)
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {rows_view(path)} WHERE {condition}")
    return name
