"""Raw files: CSV drops and JSON metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchtide.model import TableSpec
from merchtide.sources.storage import exists

CORRUPT = "_corrupt_record"
CSV_OPTIONS = {"header": True, "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
    infer: bool = False,
    misfits: bool = False,
) -> DataFrame:
    """CSV with a header and quotes doubled inside quotes.

    Columns arrive as text unless ``infer``, which costs one more pass over the
    data; silver casts them. The header of every file is compared with the first
    one, so a file with other columns fails instead of shifting values. Values with
    line breaks need ``multi_line``; such a file cannot be split, so drops should then
    be many files. ``misfits`` keeps a row that does not fit the columns whole in
    ``_corrupt_record``.
    """
    options = {**CSV_OPTIONS, "multiLine": multi_line}
    reader = spark.read.options(**options)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if schema is None:
        schema = reader.csv(path).schema
    if misfits:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_source(spark: SparkSession, raw_dir: str, spec: TableSpec, **options) -> DataFrame:
    """``<raw>/<source>.csv``, or the folder ``<raw>/<source>`` where there is no such file."""
    path = f"{raw_dir}/{spec.source_file}"
    return read_csv(spark, path if exists(spark, path) else f"{raw_dir}/{spec.source}", **options)


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Source name, ingest time and the file each row came from."""
    return df.select(
        "*",
        F.lit(source).alias("_source_name"),
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_input_file_name"),
    )


def read_json_table(spark: SparkSession, path: str, ddl: str, multi_line: bool = True) -> DataFrame:
    """A metadata file as a table with fixed columns.

    ``multi_line`` reads a file that is one JSON array; without it every line is
    a record and large files are split.
    """
    return spark.read.schema(ddl).option("multiLine", multi_line).json(path)
