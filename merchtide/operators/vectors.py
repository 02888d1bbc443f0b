"""Hashing vectors of long texts and matching against a reference set."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchtide.functions import text as tx
from merchtide.sources.storage import stage

# Bytes of a block of the reference set and of a lot of events; one of each meets in a task.
# Each event travels once per block and each entry once per lot: least in all when both are alike.
# Smaller blocks of ``with_nearest`` travel together up to this size and are scored one after the other.
BLOCK_BYTES = 1 << 24
LOT_BYTES = 1 << 24


def slot_sums(df: DataFrame, key: str, text: str, dim: int = tx.DIM) -> DataFrame:
    """(key, counts): signed token counts per vector position, texts of any length.

    Tokens are added up right where the text was read, so one small row per text
    and task reaches the shuffle. A text without tokens keeps a row of zeros.
    """
    # An empty piece has no position, so it adds nothing but keeps the text's row.
    word = F.when(F.col("_t") != "", F.col("_t"))
    hashed = df.select(key, F.explode_outer(tx.pieces(F.col(text))).alias("_t")).select(
        key, tx.hash_slot(word, dim).alias("_i"), tx.hash_sign(word).alias("_s")
    )
    sums = [
        F.sum(F.when(F.col("_i") == i, F.col("_s")).otherwise(0)).alias(f"_v{i}")
        for i in range(dim)
    ]
    slots = F.array(*[F.col(f"_v{i}") for i in range(dim)])
    return hashed.groupBy(key).agg(*sums).select(key, slots.alias("counts"))


def vectorize(df: DataFrame, key: str, text: str, dim: int = tx.DIM) -> DataFrame:
    """(key, vector): the unit hashing vector of every text."""
    return slot_sums(df, key, text, dim).select(
        key, tx.unit_vector(F.col("counts")).alias("vector")
    )


SCORE_DIGITS = 4
_CELLS = 1 << 20  # scores held at a time by one task
_TILE = 1024  # entries scored at a time where scores are estimated first
_FEW = 16  # entries scored first, to have something that the others must beat
TERMS = "array<struct<term:string,points:double>>"


def with_nearest(
    events: DataFrame,
    key: str,
    vector: str,
    kb: DataFrame,
    position: str,
    kb_vector: str,
    payload: Sequence[str] = (),
    bonus: Column | None = None,
    bonus_on: str | None = None,
    top: int = 3,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add ``matches``: the reference rows with the greatest dot product, best first.

    ``key`` identifies an event and ``position`` a reference row: unique and never NULL.
    ``bonus`` lists terms of an event with the points that a reference row gets whose
    ``bonus_on`` is that term. Scores are rounded, ties keep the reference order. An event
    without a vector, and every event of an empty reference set, has an empty list;
    reference rows without a vector are left out. ``block_bytes`` is what is scored at a time;
    however small, an event travels once per ``BLOCK_BYTES`` of the set only.
    """
    extra = [c for c in dict.fromkeys(payload) if c not in (position, kb_vector)]
    kb = stage(kb.where(F.col(kb_vector).isNotNull()).select(position, kb_vector, *extra), "reference")
    events = stage(events, "events")
    terms = F.array() if bonus is None else bonus
    asked = events.where(F.col(vector).isNotNull()).select(
        F.col(key).alias("key"), F.col(vector).alias("vector"), terms.cast(TERMS).alias("terms"))
    known = kb.select(
        F.col(position).alias("position"), F.col(kb_vector).alias("vector"),
        F.lit(None).cast("string").alias("term") if bonus_on is None else F.col(bonus_on).alias("term"))
    scored = _meet(asked, known, F.size("vector") * 8, _scorer(top, block_bytes), "score double",
                   max(block_bytes, BLOCK_BYTES))
    # The place limit is applied before the shuffle too, so a key never holds a row per block.
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "position"))
    best = scored.withColumn("place", place).where(F.col("place") <= top)
    entry = kb.select(F.col(position).alias("position"), F.struct(position, *extra).alias("entry"))
    ranked = best.join(entry, "position").select(
        "key", F.struct("place", F.struct("score", "entry").alias("match")).alias("m"))
    return _listed(events, key, ranked)


def with_mentions(
    events: DataFrame,
    key: str,
    text: str,
    kb: DataFrame,
    position: str,
    words: Column,
    payload: Sequence[str] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add ``matches``: every reference row with a word that occurs in the text, in order.

    ``key`` and ``position`` as for ``with_nearest``; ``words`` is a list of the reference
    row, an empty word stands in every text. The text is lower-cased, a NULL text mentions
    nothing. Texts meet distinct words, so what a task holds grows with the text it reads and
    not with the entries that share a word; those are joined to the words found.
    """
    kb = stage(kb.select(position, *payload, words.alias("_words")), "reference")
    events = stage(events, "events")
    asked = events.where(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.lower(text).alias("text"))
    entries = kb.select(
        F.struct(F.col(position).alias("position"),
                 F.struct(F.struct(position, *payload).alias("entry")).alias("match")).alias("m"),
        F.explode("_words").alias("word")).where("word IS NOT NULL")
    known = entries.select(F.col("word").alias("position")).distinct()
    told = _meet(asked, known, F.octet_length("position") + 16, _finder, "", block_bytes)
    named = told.withColumnRenamed("position", "word").join(entries, "word").select("key", "m")
    # Two words of one entry tell of it once.
    return _listed(events, key, named, F.collect_set)


def _meet(asked: DataFrame, known: DataFrame, weight: Column, run: Callable, added: str,
          block_bytes: int) -> DataFrame:
    """Every lot of ``asked`` meets every block of ``known`` in a group of its own.

    Both are bounded in bytes, so a group fits a task at any size, and a block travels once
    per lot and not per row. ``run`` turns the two into (key, position) rows.
    """
    wide = F.octet_length("text") if "text" in asked.columns else F.size("vector") * 8
    sizes = asked.select(F.lit("lots").alias("side"), (wide + 32).cast("long").alias("n")).unionByName(
        known.select(F.lit("blocks").alias("side"), weight.cast("long").alias("n")))
    total = {r.side: r.n for r in sizes.groupBy("side").agg(F.sum("n").alias("n")).collect()}
    blocks = max(1, -(-total.get("blocks", 0) // block_bytes))
    # A small input is dealt over all cores.
    cores = asked.sparkSession.sparkContext.defaultParallelism
    lots = max(1, -(-total.get("lots", 0) // LOT_BYTES), -(-cores // blocks))
    left = asked.withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(lots)).cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = known.withColumn("_block", F.pmod(F.xxhash64("position"), F.lit(blocks)).cast("int")).withColumn(
        "_lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    schema = T.StructType([
        T.StructField("key", asked.schema["key"].dataType),
        T.StructField("position", known.schema["position"].dataType),
        *T.StructType.fromDDL(added),
    ])
    group = ["_block", "_lot"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(run, schema)


def _listed(events: DataFrame, key: str, found: DataFrame,
            gather: Callable[[str], Column] = F.collect_list) -> DataFrame:
    """Add ``matches`` from ``found(key, m)``, in the order of ``m``; none is an empty list."""
    lists = found.groupBy("key").agg(F.sort_array(gather("m")).alias("_m")).select(
        F.col("key").alias("_key"), F.transform("_m", lambda m: m["match"]).alias("matches"))
    none = F.array().cast(lists.schema["matches"].dataType)
    return events.join(lists, F.col(key) == F.col("_key"), "left").select(
        *[F.col(f"`{c}`") for c in events.columns], F.coalesce("matches", none).alias("matches"))


def _scorer(top: int, block_bytes: int = BLOCK_BYTES) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores a lot of events against a block, and keeps the best of each event."""
    scale = 10.0**SCORE_DIGITS

    def rows_of(table: pa.Table) -> np.ndarray:
        flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.astype(float).reshape(table.num_rows, -1)

    def points(asked: pa.Table, of_entry: np.ndarray, terms: pa.Array) -> np.ndarray:
        listed = asked["terms"].combine_chunks()
        flat = listed.flatten()
        row = np.repeat(np.arange(len(listed)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
        code = pc.index_in(flat.field("term"), value_set=terms).fill_null(-1).to_numpy()
        table = np.zeros((len(listed), len(terms) + 1))
        np.add.at(table, (row, code), flat.field("points").to_numpy(zero_copy_only=False))
        table[:, -1] = 0.0  # what no entry has
        return table[:, of_entry]

    def best(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Only what reaches the least score that can stay is sorted; not a number comes last.
        rank = np.where(np.isnan(total), -np.inf, total)
        few = min(top, rank.shape[1])
        least = np.partition(rank, -few, axis=1)[:, -few, None]
        row, entry = np.nonzero(rank >= least)
        order = np.lexsort((entry, -rank[row, entry], row))
        row, entry = row[order], entry[order]
        stays = np.arange(len(row)) - np.searchsorted(row, row) < top
        return row[stays], entry[stays]

    def every(left: np.ndarray, matrix: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """(row, entry, score) of the best, from the scores of all pairs."""
        total = np.zeros((len(left), len(matrix)))
        # One position after the other, so that sums round as a plain loop's do.
        for i in range(left.shape[1]):
            total += left[:, i : i + 1] * matrix[:, i]
        if extra is not None:
            total += extra
        total = np.rint(total * scale) / scale
        row, entry = best(total)
        return row, entry, total[row, entry]

    def telling(left: np.ndarray, matrix: np.ndarray, near: np.ndarray, near_known: np.ndarray,
                slack: np.ndarray, wide: int) -> tuple[np.ndarray, ...]:
        """As ``every``, from the scores of those pairs that an estimate does not rule out.

        Entries come in order, so a later one must beat the least score kept by a whole step of
        the rounding; ``slack`` is more than an estimate can be off.
        """
        # The best so far of each event, the first first; places without an entry hold none.
        few = min(top, len(matrix))
        score, entry = np.full((len(left), few), -np.inf), np.full((len(left), few), len(matrix))
        at, width = 0, min(wide, max(few, _FEW))
        while at < len(matrix):
            # Rounded down, so that no pair is lost by the shorter float.
            floor = np.nextafter((score[:, -1] + 0.5 / scale - slack).astype(np.float32), np.float32(-np.inf))
            hit = np.flatnonzero(near @ near_known[at : at + width].T >= floor[:, None])
            if len(hit):
                r, e = np.divmod(hit, min(width, len(matrix) - at))
                e += at
                total = np.zeros(len(r))
                for i in range(left.shape[1]):
                    total += left[r, i] * matrix[e, i]
                total = np.rint(total * scale) / scale
                better = total > score[r, -1]
                r, e, total = r[better], e[better], total[better]
                rows = np.unique(r)
                r = np.concatenate((np.repeat(rows, few), r))
                e = np.concatenate((entry[rows].ravel(), e))
                total = np.concatenate((score[rows].ravel(), total))
                order = np.lexsort((e, -total, r))
                stays = order[np.arange(len(r)) - np.searchsorted(r[order], r[order]) < few]
                entry[rows], score[rows] = e[stays].reshape(-1, few), total[stays].reshape(-1, few)
            at, width = at + width, min(wide, width * 2)
        row, place = np.nonzero(entry < len(matrix))
        return row, entry[row, place], score[row, place]

    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and known.num_rows:
            known = known.sort_by("position")
            matrix = rows_of(known)
            of = known["term"].combine_chunks()
            terms = pc.drop_null(pc.unique(of))
            of_entry = pc.index_in(of, value_set=terms).fill_null(-1).to_numpy()
            dim = matrix.shape[1]
            long = np.sqrt((matrix * matrix).sum(1).max())
            wide = min(_TILE, max(1, block_bytes // (8 * max(dim, 1))))
            step = max(1, _CELLS // len(matrix))
            # Estimates are for plain products of a size that a short float holds.
            estimated = not len(terms) and dim and long < 1e15
            near_known = matrix.astype(np.float32) if estimated else None
            lot = _CELLS // wide if estimated else step
            for at in range(0, asked.num_rows, lot):
                some = asked.slice(at, lot)
                left = rows_of(some)
                length = np.sqrt((left * left).sum(1))
                if estimated and length.max() < 1e15:
                    # Twice the bound on the rounding of the short floats and their products and sums.
                    slack = (dim + 8) * 2.0**-23 * length * long + 1e-30
                    parts = [(0, telling(left, matrix, left.astype(np.float32), near_known, slack, wide))]
                else:
                    parts = [
                        (n, every(left[n : n + step], matrix, points(some.slice(n, step), of_entry, terms)
                                  if len(terms) else None))
                        for n in range(0, len(left), step)]
                for n, (row, entry, score) in parts:
                    found.append(pa.table({
                        "key": some["key"].take(pa.array(row + n)),
                        "position": known["position"].take(pa.array(entry)),
                        "score": score,
                    }))
        if found:
            return pa.concat_tables(found)
        return pa.table({
            "key": asked["key"].slice(0, 0), "position": known["position"].slice(0, 0),
            "score": pa.array([], pa.float64())})

    return run


def _finder(asked: pa.Table, known: pa.Table) -> pa.Table:
    """(key, position) of each event whose text holds the word ``position``.

    All words of the block are found in one pass over each text; an event gives a row per
    distinct word in it, so the result is bounded by the texts of the lot.
    """
    words = known["position"].to_pylist()
    anywhere = [n for n, word in enumerate(words) if not word]
    automaton = ahocorasick.Automaton()
    for n, word in enumerate(words):
        if word:
            automaton.add_word(word, n)
    if len(automaton):
        automaton.make_automaton()
    row, hit = array("q"), array("q")
    for n, text in enumerate(asked["text"]):
        met = {w for _, w in automaton.iter(text.as_py())} if len(automaton) else set()
        met.update(anywhere)
        row.extend([n] * len(met))
        hit.extend(met)
    rows, hits = (pa.array(np.frombuffer(a, np.int64) if a else np.empty(0, np.int64)) for a in (row, hit))
    return pa.table({"key": asked["key"].take(rows), "position": known["position"].take(hits)})
