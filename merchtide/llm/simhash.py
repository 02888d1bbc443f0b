"""Near-duplicate texts by SimHash fingerprints and a generalised pigeonhole join.

A fingerprint has one bit per column of the shingle hashes. Two texts are linked when their
fingerprints differ in at most ``distance`` bits. The bits are dealt to parts, correlated
bits together. Part i gets u_i units, the units add up to ``distance + 1``; a pair whose
parts all differ in at least u_i bits differs in more than ``distance`` bits in all, so every
link shows in a part that differs in fewer than u_i bits. The units are chosen by dynamic
programming over the estimated work, so a large corpus gets wide parts probed with flipped
bits and a small one narrow parts probed as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.bitmap import bitmap_of, may_hold
from merchtide.llm.common import boxed, prepared
from merchtide.llm.components import connected
from merchtide.sources.storage import stage

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
# Fingerprints looked at to choose the parts. It only steers the work, never the result.
PLAN_SAMPLE = 4096
# Fingerprints of one bucket that a task compares at once; larger buckets meet block by block.
BLOCK = 1 << 15
# Shingles hashed at once, so that a very long text needs no more memory than a short one.
HASHED_AT_ONCE = 1 << 16
# Rows gathered before their buckets are compared; a single larger bucket is still kept whole.
COMPARED_AT_ONCE = 1 << 15
# Bits of the filter for the rows that go; its size does not depend on their number.
FILTER_BITS = 1 << 22
# Work of one row sent to a bucket and of one comparison in it.
ROW_COST, PAIR_COST = 1.0, 0.02


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned number; zero for a null text or one without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    shingles = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:shingles]
    ends = ends[-shingles:]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, shingles, HASHED_AT_ONCE):
        spans = zip(starts[at:at + HASHED_AT_ONCE].tolist(), ends[at:at + HASHED_AT_ONCE].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > shingles, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a long (the same 64 bits)."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return run(F.coalesce(text, F.lit("")))


@dataclass(frozen=True)
class Part:
    """Bits of the fingerprint, and in how many fewer than ``units`` of them a probe may differ."""

    bits: tuple[int, ...]
    units: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    @property
    def flips(self) -> list[int]:
        """What to flip to reach every value a probe may have."""
        chosen = (c for n in range(self.units) for c in combinations(self.bits, n))
        return [_signed(sum(1 << b for b in c)) for c in chosen]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def grouped_bits(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """The bits in ``parts`` groups of nearly equal size, each grown by its most correlated bits."""
    table = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    table = table - table.mean(axis=0)
    norm = np.sqrt((table ** 2).sum(axis=0))
    scale = np.outer(norm, norm)
    related = np.abs(np.divide(table.T @ table, scale, out=np.zeros((BITS, BITS)), where=scale > 0))
    free, groups = list(range(BITS)), []
    for g in range(parts):
        size = BITS // parts + (g < BITS % parts)
        group = [max(free, key=lambda b: (related[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            nearest = max(free, key=lambda b: (related[b, group].sum(), -b))
            group.append(nearest)
            free.remove(nearest)
        groups.append(tuple(sorted(group)))
    return groups


def _close_pairs(sample: np.ndarray, bits: tuple[int, ...], distance: int) -> np.ndarray:
    """How many pairs of the sample differ in at most 0, 1, ... ``distance`` of the bits."""
    values = sample & np.uint64(sum(1 << b for b in bits))
    found = np.zeros(distance + 1)
    for at in range(0, len(values), 256):
        apart = np.bitwise_count(values[at:at + 256, None] ^ values[None, :])
        found += np.bincount(apart.ravel(), minlength=BITS + 1)[: distance + 1]
    found[0] -= len(values)
    return np.cumsum(found) / 2


def plan_parts(sample: np.ndarray, total: int, distance: int = MAX_DISTANCE) -> list[Part]:
    """The parts and units with the least estimated work for ``total`` distinct fingerprints.

    For every number of parts up to ``distance + 1`` the units are dealt by dynamic
    programming. The work of a part is the rows it sends to buckets plus the comparisons,
    estimated from the sample's pairs and never below what evenly spread values would give.
    """
    best: tuple[float, list[Part]] | None = None
    need = distance + 1
    grow = (total / max(1, len(sample))) ** 2
    for parts in range(1, need + 1):
        groups = grouped_bits(sample, parts)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in groups:
            close = _close_pairs(sample, bits, distance)
            work = [0.0]
            for t in range(need):
                ball = sum(comb(len(bits), k) for k in range(t + 1))
                even = total ** 2 / 2 * ball / 2.0 ** len(bits)
                work.append(ROW_COST * total * (ball + (t > 0)) + PAIR_COST * max(close[t] * grow, even))
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, dealt) in table.items():
                for u in range(need - used + 1):
                    entry = (cost + work[u], [*dealt, u])
                    if used + u not in step or entry < step[used + u]:
                        step[used + u] = entry
            table = step
        cost, dealt = table[need]
        if best is None or cost < best[0]:
            best = (cost, [Part(b, u) for b, u in zip(groups, dealt) if u])
    return best[1]


def _merge(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Join the sets of each pair; ``label`` points from every item straight to its set's first."""
    while True:
        a, b = label[one], label[other]
        apart = a != b
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def _bucket_links(rows: pd.DataFrame, distance: int) -> pd.DataFrame:
    """A spanning set of the links inside each bucket: never more rows than fingerprints.

    The rows are sorted by bucket. Every row meets the row 1, 2, ... places on in its
    bucket; pairs already joined are not looked at again.
    """
    prints = rows["print"].to_numpy().view(np.uint64)
    home = rows["home"].to_numpy()
    keys = rows[["part", "key", "low", "high"]].to_numpy()
    bucket = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1)))) if len(rows) else keys[:, 0]
    label = np.arange(len(rows))
    at, step = label[:-1], 1
    while len(at):
        at = at[at + step < len(rows)]
        at = at[bucket[at] == bucket[at + step]]
        new = at[(label[at] != label[at + step]) & (home[at] | home[at + step])]
        new = new[np.bitwise_count(prints[new] ^ prints[new + step]) <= distance]
        label = _merge(label, new, new + step)
        step += 1
    moved = np.flatnonzero(label != np.arange(len(rows)))
    found = pd.DataFrame({"a": prints[moved].view(np.int64), "b": prints[label[moved]].view(np.int64)})
    return found[found["a"] != found["b"]].drop_duplicates()


def links(prints: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK,
          sample_rows: int = PLAN_SAMPLE) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``prints(print)`` as all links would.

    Each bucket gives a spanning set of its links, so the edges grow with the fingerprints
    and not with the square of a group. A bucket over ``block`` rows is split, and its blocks
    meet pair by pair in separate groups.
    """
    order = F.xxhash64("print")
    picked = prints.select("print", order.alias("h")).orderBy("h", "print").limit(sample_rows).collect()
    sample = np.array([r["print"] for r in picked], np.int64).view(np.uint64)
    plan = plan_parts(sample, prints.count(), distance)
    probes = [
        F.struct(F.lit(i).alias("part"), F.lit(p.mask).alias("mask"), F.lit(f).alias("flip"))
        for i, p in enumerate(plan) for f in p.flips
    ]
    sent = (
        prints.select("print", F.explode(F.array(*probes)).alias("p"))
        .select(
            "print", "p.part",
            F.col("print").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip")).alias("key"),
            (F.col("p.flip") == 0).alias("home"))
    )
    large = sent.groupBy("part", "key").count().where(F.col("count") > block).select(
        "part", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    dealt = (
        sent.join(stage(large, "large-buckets"), ["part", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("part", "key", F.least("own", "other").alias("low"),
                F.greatest("own", "other").alias("high"), "print", "home")
    )
    bucket = ["part", "key", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, size = [], 0
        for rows in batches:
            kept, size = [*kept, rows], size + len(rows)
            if size < COMPARED_AT_ONCE:
                continue
            rows = pd.concat(kept, ignore_index=True)
            keys = rows[bucket].to_numpy()
            begins = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(begins):  # the last bucket may go on in the next batch
                yield _bucket_links(rows[:begins[-1]], distance)
                rows = rows[begins[-1]:]
            kept, size = [rows], len(rows)
        if kept:
            yield _bucket_links(pd.concat(kept, ignore_index=True), distance)

    spread = dealt.repartition(*bucket).sortWithinPartitions(*bucket, "print")
    return spread.mapInPandas(run, "a long, b long")


def with_components(rows: DataFrame, doc_id: str, print_column: str,
                    distance: int = MAX_DISTANCE) -> DataFrame:
    """Add ``component_id``: the smallest id reachable over links of the fingerprints.

    ``rows`` must be cheap to read again (a written table). Equal fingerprints become one
    node before anything is compared, so thousands of copies cost one. Null ids take no part
    in the minimum; a component of null ids only has a null ``component_id``.
    """
    own = rows.select(F.col(print_column).alias("print"), F.col(doc_id).alias("id"))
    nodes = stage(own.groupBy("print").agg(F.min("id").alias("first_id")), "prints")
    roots = stage(connected(links(nodes.select("print"), distance)), "roots")
    placed = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = placed.join(smallest, "root").select(
        F.col("print").alias("component_of_print"), "component_id")
    return rows.join(of_print, rows[print_column] == F.col("component_of_print"), "left").drop(
        "component_of_print")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows
    stay rows of their own; an empty table gives no rows; other columns are not looked at.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint_of(F.col(text), words).alias("print"))
    found = with_components(stage(rows, "fingerprints"), "doc_id", "print", distance)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id.

    Null ids come last. Rows that tie in the id are told apart by a number given when the
    rows are written, so exactly one row of each component stays.
    """
    prepared(docs.sparkSession)
    rows = stage(
        docs.select(
            boxed(docs), F.col(doc_id).alias("id"), fingerprint_of(F.col(text), words).alias("print"),
            F.monotonically_increasing_id().alias("number")),
        "numbered")
    slim = rows.select("id", "print", "number")
    nodes = stage(slim.groupBy("print").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "number")).alias("first")), "prints")
    roots = stage(connected(links(nodes.select("print"), distance)), "roots")
    kept = (
        nodes.join(roots, nodes["print"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "print")).agg(F.min("first").alias("first"))
        .select(F.col("first.number").alias("number"))
    )
    gone = stage(slim.select("number").join(kept, "number", "left_anti").withColumn("hash", F.xxhash64("number")), "gone")
    # Rows outside a bitmap of what goes stay without a join, so few texts are shuffled.
    bitmap = stage(bitmap_of(gone, FILTER_BITS), "bitmap").select("bitmap").scalar()
    maybe = may_hold(bitmap, F.xxhash64("number"), FILTER_BITS)
    sure = rows.where(~maybe)
    return sure.union(rows.where(maybe).join(gone.select("number"), "number", "left_anti").select(*rows.columns)).select("row.*")
