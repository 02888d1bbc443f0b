"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchtide.session import configure

# Rows and bytes per Arrow batch. Texts differ by four orders of magnitude in length, so a
# batch is bounded in bytes as well.
BATCH_ROWS, BATCH_BYTES = "2000", "8m"
# Code points of a text cut at once.
BLOCK = 1024


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows no model may learn from; a null id counts as empty text."""
    digest = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return digest % 4 == 2


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def boxed(docs: DataFrame) -> Column:
    """All columns as one value, so that no name of theirs can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def first_of_each(rows: DataFrame, group: str, order: str, most: int, lots: int = 64) -> DataFrame:
    """The ``most`` first rows of each group by ``order``, with a hot group split into lots first.

    Every lot keeps its own first rows, so what meets at the end is ``lots`` times ``most``
    rows of a group, however large the group is.
    """
    rows = rows.withColumn("_lot", F.pmod(F.xxhash64(order, F.lit(1)), F.lit(lots)))
    for keys in ((group, "_lot"), (group,)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
    return rows.drop("_lot")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` or its lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(text: Column) -> Column:
    """A text in blocks of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in blocks, without a walk from its start."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")

    def part(block: Column, begin: Column, size: Column) -> Column:
        return F.substr(F.coalesce(F.get(blocks, block), F.lit("")), begin.cast("int") + 1, size.cast("int"))

    many = F.concat(
        part(first, start % BLOCK, F.lit(BLOCK)), F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        part(last, F.lit(0), end % BLOCK))
    return F.when(first == last, part(first, start % BLOCK, end - start)).otherwise(many)
