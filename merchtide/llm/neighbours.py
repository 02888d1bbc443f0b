"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit
vector, and the nearest of the 2d signed axes is its code. Every vector stands in one bucket
per table; a query also probes the buckets of its next nearest axes. What the buckets hold is
reranked exactly. Work per query is the share ``tables * probes / 2d`` of all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchtide.llm.common import prepared
from merchtide.sources.storage import stage

TABLES = 24
PROBES = 4
SEED = 7
# Vectors of a bucket that meet in one group; larger buckets are dealt to lots of about this size.
LOT_ROWS = 1 << 14
# Queries that a group holds in memory at most, about; more are dealt to lots of their own.
QUERY_ROWS = 1 << 12
SLACK = 1e-9


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row; the width must be a power of two."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, width // (2 * step), 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return rows


def codes(vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The nearest signed axes of each row under the table's rotation, nearest first."""
    width = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    signs = np.random.default_rng([SEED, table, width]).choice([-1.0, 1.0], (3, width))
    turned = np.zeros((len(vectors), width))
    turned[:, :vectors.shape[1]] = vectors
    for s in signs:
        turned = hadamard(turned * s) / np.sqrt(width)
    axis = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :min(probes, width)]
    return axis * 2 + (np.take_along_axis(turned, axis, 1) < 0)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, vector)`` of the vectors that have a direction."""
    body = F.col(embedding).cast("array<double>")
    bad = F.exists(body, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull()).where(
        ~bad & F.exists(body, lambda x: x != 0))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), body.alias("vector"))


def _placed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """A row per table and probe with the bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for width, part in rows.groupby(rows["vector"].map(len)):
                matrix = np.stack(part["vector"].to_numpy())
                for table in range(tables):
                    found = codes(matrix, table, probes)
                    for p in range(found.shape[1]):
                        yield pd.DataFrame({
                            "width": width, "slot": table, "code": found[:, p],
                            "vec_id": part["vec_id"].to_numpy(), "vector": part["vector"].to_numpy()})

    return rows.mapInPandas(run, "width int, slot int, code int, vec_id long, vector array<double>")


def _nearest(ids: np.ndarray, queries: np.ndarray, other_ids: np.ndarray, others: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` nearest others of each query: a matrix product, then exact scores of the best."""
    norm = np.sqrt((queries * queries).sum(axis=1))
    other_norm = np.sqrt((others * others).sum(axis=1))
    rough = (queries / norm[:, None]) @ (others / other_norm[:, None]).T
    rough[ids[:, None] == other_ids[None, :]] = -np.inf
    found = []
    for q in range(len(ids)):
        line = rough[q]
        if len(line) > k:
            near = np.flatnonzero(line >= np.partition(line, -k)[-k] - SLACK)
        else:
            near = np.arange(len(line))
        near = near[line[near] > -np.inf]
        score = (others[near] * queries[q]).sum(axis=1) / (norm[q] * other_norm[near])
        order = np.lexsort((other_ids[near], -score))[:k]
        found += [(int(ids[q]), int(other_ids[near[o]]), float(score[o])) for o in order]
    return found


def _searched(queries: DataFrame, others: DataFrame, lots: int, query_lots: int, k: int) -> DataFrame:
    """The nearest of each query per bucket, lot of others and lot of queries.

    The rows of a group come sorted, queries first; the others stream by in batches and only
    the best of each query leave. What a task holds is one lot of queries, however many of them
    a bucket draws.
    """
    bucket = ["width", "slot", "code", "lot", "query_lot"]

    def dealt(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = queries.select("*", every(lots).alias("lot"), dealt(query_lots).alias("query_lot"), F.lit(False).alias("other"))
    met = others.select("*", dealt(lots).alias("lot"), every(query_lots).alias("query_lot"), F.lit(True).alias("other"))
    rows = asked.unionByName(met).repartition(*bucket).sortWithinPartitions(*bucket, "other", "vec_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ids, vectors, matrix = None, [], [], None
        for rows in batches:
            found = []
            keys = rows[bucket].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(rows)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if now != tuple(keys[start]):
                    now, ids, vectors, matrix = tuple(keys[start]), [], [], None
                part = rows[start:end]
                own = ~part["other"].to_numpy()
                ids += part["vec_id"][own].tolist()
                vectors += part["vector"][own].tolist()
                rest = part[~own]
                if ids and len(rest):
                    if matrix is None:  # all queries of the group came before the first other
                        matrix = np.stack(vectors)
                    found += _nearest(np.array(ids), matrix, rest["vec_id"].to_numpy(),
                                      np.stack(rest["vector"].to_numpy()), k)
            yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return rows.mapInPandas(run, "query_id long, vec_id long, score double")


def _lots(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id",
            embedding: str = "embedding", tables: int = TABLES, probes: int = PROBES,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query, itself left out.

    The score is the cosine in double precision, ties go to the smaller id. Of equal vectors
    only the ``k + 1`` smallest ids can be among the nearest, so a hot vector costs no more than
    those. A query that its buckets give fewer than ``k`` neighbours is compared with all
    vectors, in lots. Null, zero and non-finite vectors and null ids take no part; vectors of
    another length are never compared; empty tables give no rows.
    """
    prepared(vectors.sparkSession)
    same = Window.partitionBy("vector").orderBy("vec_id")
    others = usable(vectors, vec_id, embedding).distinct().withColumn("place", F.row_number().over(same)).where(
        F.col("place") <= k + 1).drop("place")
    others = stage(others, "vectors")
    asked = stage(usable(queries, vec_id, embedding).distinct(), "queries")
    n_others = others.count()
    lots, query_lots = _lots(n_others, LOT_ROWS * 16), _lots(asked.count(), query_rows)
    found = stage(_searched(_placed(asked, tables, probes), _placed(others, tables, 1), lots, query_lots, k), "found")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    few = asked.join(best.groupBy("query_id").count().where(F.col("count") >= k),
                     F.col("vec_id") == F.col("query_id"), "left_anti")
    few = stage(few, "few-found")
    if not few.isEmpty():
        def one_bucket(rows: DataFrame) -> DataFrame:
            return rows.select(F.size("vector").alias("width"), F.lit(-1).alias("slot"), F.lit(0).alias("code"),
                               "vec_id", "vector")

        lots, query_lots = _lots(n_others, LOT_ROWS), _lots(few.count(), query_rows)
        rest = stage(_searched(one_bucket(few), one_bucket(others), lots, query_lots, k), "scanned")
        best = found.union(rest).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
