"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source gets a target in words. A document's expected copies are drawn towards its
preference around the source's mean so that the expected words equal the target. The whole
copies are certain; the remaining fraction is an inclusion probability, and documents are
taken in the order of u / (1 - u) divided by p / (1 - p) until the words are reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchtide.llm.common import prepared
from merchtide.sources.storage import stage

# Weights of the sources in code point order, repeating; the mix's share of all
# words; the most copies of a document, and so of a source.
WEIGHTS = (3, 1, 2)
SHARE_NUMERATOR, SHARE_DENOMINATOR = 3, 2
MOST = 2
# Documents of this many words have half the greatest preference.
HALF_WORDS = 256
# The order is cut in so many bins of rank; only the bin with the cut is sorted.
BINS = 4096
SPACES = " \t\n\x0b\x0c\r"


def words_in(text: Column) -> Column:
    """Number of runs without ASCII white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    edge = [F.substring(text, at, 1).isin(*SPACES).cast("long") for at in (1, -1)]
    pieces = F.size(F.split(text, r"[\x20\x09-\x0D]+")).cast("long")
    return F.when(text == "", F.lit(0).cast("long")).otherwise(pieces - edge[0] - edge[1])


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, liked, target)`` per source: water level with caps.

    One window goes over all sources; it has one row per source, never one per document.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("like")).alias("liked"))
    total = Window.partitionBy()
    named = Window.orderBy(F.asc_nulls_last("source"))
    spot = (F.row_number().over(named) - 1) % len(WEIGHTS)
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), spot).cast("long")
    weighed = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(
        Window.unboundedPreceding, -1)
    goal = F.sum("source_size").over(total) * SHARE_NUMERATOR / SHARE_DENOMINATOR
    open_weight = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
    level = (goal - F.coalesce(F.sum("cap").over(filled), F.lit(0))) / open_weight
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(total))
        .select("source", "source_size", "liked", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` for every row of ``docs``.

    A null text has size 0 and takes nothing; a null source is a source of its own, last in
    order. The random number of a row is a digest of its id and text, so reruns agree; repeated
    rows share it and are interchangeable. A source misses its target by at most half of one
    document. Documents of a source never meet in one task: ranks are summed per bin first, and
    only the bin in which the target is reached is sorted. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), body).cast("binary"))
    sizes = stage(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                    words_in(F.col(text)).alias("size"), digest.alias("digest"))
        .withColumn("like", F.floor(F.col("size") * 1000 / (F.col("size") + HALF_WORDS))),
        "sizes")
    goals = stage(targets(sizes), "targets").withColumnRenamed("source", "of_source")
    chance = F.conv(F.substring("digest", 1, 13), 16, 10).cast("long")
    ranked = (
        sizes.join(goals, sizes["source"].eqNullSafe(goals["of_source"])).drop("of_source")
        .withColumn("mean", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
        .withColumn("lean", F.col("like") / 1000.0 - F.coalesce(F.try_divide("liked", "source_size"), F.lit(0.0)) / 1000.0)
        .withColumn("expected", F.col("mean") + F.least(F.col("mean"), MOST - F.col("mean")) * F.col("lean"))
        .withColumn("whole", F.greatest(F.floor("expected"), F.lit(0).cast("long")))
        .withColumn("p", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
        .withColumn("u", (chance + 0.5) / F.lit(float(1 << 52)))
        .withColumn("rank", F.when(F.col("p") > 0, F.col("u") * (1 - F.col("p")) / ((1 - F.col("u")) * F.col("p")))
                    .otherwise(F.lit(float("inf"))))
        .withColumn("bin", F.when(F.col("p") > 0, F.least(F.floor(F.col("rank") / (1 + F.col("rank")) * BINS), F.lit(BINS - 1)))
                    .otherwise(F.lit(BINS)).cast("int"))
    )
    bins = ranked.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.sum(F.col("whole") * F.col("size")).alias("certain"),
        F.first("target").alias("target"))
    whole = Window.partitionBy("source")
    before = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        bins.withColumn("room", F.col("target") - F.sum("certain").over(whole))
        .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .where("bin < {} AND before + words > room".format(BINS))
        .groupBy("source").agg(F.min(F.struct("bin", "before", "room")).alias("cut"))
        .select(F.col("source").alias("cut_source"), "cut.*")
        .withColumnRenamed("bin", "cut_bin")
    )
    cut = ranked.join(stage(cuts, "cuts"), F.col("source").eqNullSafe(F.col("cut_source")), "left")
    at_cut = F.col("bin") == F.coalesce("cut_bin", F.lit(BINS))
    in_bin = Window.partitionBy("source", "bin").orderBy("rank", "doc_id", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = cut.where(at_cut & (F.col("bin") < BINS)).withColumn(
        "extra", (F.col("before") + F.coalesce(F.sum("size").over(in_bin), F.lit(0)) + F.col("size") / 2.0
                  <= F.col("room")).cast("long"))
    outside = cut.where(~at_cut | (F.col("bin") >= BINS)).withColumn(
        "extra", (F.col("bin") < F.coalesce("cut_bin", F.lit(BINS))).cast("long"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(F.lit(0)).cast("long")
    return inside.unionByName(outside).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))
