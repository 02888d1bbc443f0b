"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed is a mask over a span of words; only the words under its ones are hashed, so a
substituted word under a zero does no harm. Benchmark windows are indexed by seed and hash.
Training windows are looked up first in a bitmap of fixed size and then joined. A hit fixes
how the item lies against the document; both are then compared word by word along it.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.bitmap import bitmap_of, may_hold
from merchtide.llm.common import boxed, prepared
from merchtide.sources.storage import stage

# Masks of weight 6, found by a random search for the set that misses the fewest overlaps of 12 to
# 20 words with a fifth substituted; ``missed`` counts what a set misses.
SEEDS = ("11101101", "101110011", "11010001011", "101001010011")
# Bits of the bitmap. It has this size whatever the benchmark has; a full one only filters less.
FILTER_BITS = 1 << 22
# An overlap counts from so many equal words on, and when so many of its words are equal.
LEAST_WORDS = 10
LEAST_SHARE = 0.8


def missed(masks: tuple[str, ...], words: int, changed: int) -> float:
    """Share of the ways to substitute ``changed`` of ``words`` words in which no mask fits in between."""
    under = [sum(1 << k for k, bit in enumerate(mask) if bit == "1") for mask in masks]
    places = [u << at for u, mask in zip(under, masks) for at in range(words - len(mask) + 1)]
    ways = [sum(1 << k for k in way) for way in combinations(range(words), changed)]
    return sum(all(place & way for place in places) for way in ways) / len(ways)


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; an empty list for a null or word-less text."""
    pieces = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(pieces, lambda w: w != "")


def _windows(texts: DataFrame, keep: list[str], masks: tuple[str, ...]) -> DataFrame:
    """``at`` and a hash per seed, ``h0``, ``h1``, ..., of every window; null where it does not fit.

    The word hashes are zipped with themselves moved by one, two, ... places. A row per window
    then carries the few numbers under the masks and never the word array, and the seeds are
    hashed in generated code.
    """
    under = [[k for k, bit in enumerate(mask) if bit == "1"] for mask in masks]
    moves = sorted(set().union(*under))
    moved = [F.when(F.size("hashes") > k, F.slice("hashes", k + 1, F.size("hashes"))).alias(f"w{k}") for k in moves]
    rows = texts.where(F.size("words") >= min(map(len, masks))).select(
        *keep, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    rows = rows.select(*keep, F.sequence(F.lit(0), F.size("hashes") - 1).alias("at"), *moved)
    names = [f"w{k}" for k in moves]
    rows = rows.select(*keep, F.inline(F.arrays_zip("at", *[F.coalesce(n, F.array().cast("array<long>")).alias(n) for n in names])))
    return rows.select(*keep, "at", *[
        F.when(F.col(f"w{ones[-1]}").isNotNull(), F.xxhash64(F.lit(i), *[f"w{k}" for k in ones])).alias(f"h{i}")
        for i, ones in enumerate(under)])


def _hashes(windows: DataFrame, keep: list[str], count: int) -> DataFrame:
    """The hashes of all seeds as rows ``at``, ``hash``."""
    each = F.explode(F.array(*[F.col(f"h{i}") for i in range(count)])).alias("hash")
    return windows.select(*keep, "at", each).where(F.col("hash").isNotNull())


def _overlap(shift: Column, least_share: float) -> Column:
    """The stretch with most equal words of which ``least_share`` are, item and document ``shift`` apart.

    With a running sum that rises for an equal word and falls for another, a stretch has the share
    when the sum does not end below its start. So the widest stretch that ends at a word starts
    where the sum first was no higher; ``lows`` holds that place for every depth below zero. The
    result is ``(best_same, best_first, best_last)`` in item positions, from an equal word to one.
    """
    share = Fraction(str(least_share))
    up, down = share.denominator - share.numerator, share.numerator
    begin = F.greatest(-shift, F.lit(0))
    end = F.least(F.size("item_words"), F.size("words") - shift)
    empty = F.struct(*[F.lit(v).alias(n) for n, v in (
        ("sum", 0), ("same", 0), ("best_same", 0), ("best_first", 0), ("best_last", -1))],
        F.array().cast("array<struct<at:int,same:int>>").alias("lows"))

    def same_word(k: Column) -> Column:
        return F.get("item_words", k) == F.get("words", k + shift)

    def step(s: Column, k: Column) -> Column:
        equal = same_word(k)
        total = s["sum"] + F.when(equal, up).otherwise(-down)
        same = s["same"] + F.when(equal, 1).otherwise(0)
        start = F.when(total >= 0, F.struct(begin.alias("at"), F.lit(0).alias("same"))).otherwise(
            F.get(s["lows"], -total - 1))
        better = equal & (same - start["same"] > s["best_same"])
        deeper = -total - F.size(s["lows"])
        place = F.struct((k + 1).alias("at"), same.alias("same"))
        return F.struct(
            total.alias("sum"), same.alias("same"),
            F.when(better, same - start["same"]).otherwise(s["best_same"]).alias("best_same"),
            F.when(better, start["at"]).otherwise(s["best_first"]).alias("best_first"),
            F.when(better, k).otherwise(s["best_last"]).alias("best_last"),
            F.when(deeper > 0, F.concat(s["lows"], F.array_repeat(place, deeper))).otherwise(s["lows"]).alias("lows"))

    walk = F.when(end > begin, F.sequence(begin, end - 1)).otherwise(F.array().cast("array<int>"))

    def trimmed(s: Column) -> Column:
        # Other words before the first equal one only thin the stretch.
        inside = F.when(s["best_same"] > 0, F.sequence(s["best_first"], s["best_last"]))
        ahead = F.array_position(F.transform(inside, same_word), F.lit(True)) - 1
        return F.struct(s["best_same"].alias("best_same"), (s["best_first"] + F.coalesce(ahead, F.lit(0))).cast("int").alias("best_first"),
                        s["best_last"].alias("best_last"))

    return F.aggregate(walk, empty, step, trimmed)


def contaminations(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", masks: tuple[str, ...] = SEEDS,
                   bits: int = FILTER_BITS, least_words: int = LEAST_WORDS,
                   least_share: float = LEAST_SHARE) -> DataFrame:
    """``(doc_id, digest, item_id, n_same, n_overlap, n_item, share, first_word, last_word)``.

    One row per document and item with a verified overlap: the one with most equal words, counted in words of
    the document from 0. An overlap has ``least_words`` equal words (or all of a shorter item)
    and at least ``least_share`` of its words equal. Items shorter than the shortest seed are
    looked for as a whole. ``digest`` tells texts with the same id apart; repeated rows give one
    result, null ids are kept, null texts never match, and empty tables give no rows.
    """
    prepared(docs.sparkSession)
    shortest = min(map(len, masks))
    items = stage(benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(item_text)).alias("words"))
                  .where(F.size("words") > 0).distinct(), "items")
    sized = items.withColumn("n_item", F.size("words"))
    index = _hashes(_windows(sized, ["item_id", "n_item"], masks), ["item_id", "n_item"], len(masks))
    # An item too short for a seed is one hash of all its words, marked by its length.
    small = sized.where(F.size("words") < shortest).select(
        "item_id", "n_item", F.lit(0).alias("at"), F.xxhash64(-F.size("words"), F.array_join("words", " ")).alias("hash"))
    index = stage(index.union(small).withColumnRenamed("at", "item_at").distinct(), "seed-index")
    bitmap = stage(bitmap_of(index, bits), "bitmap")
    lengths = items.where(F.size("words") < shortest).agg(
        F.sort_array(F.collect_set(F.size("words"))).alias("n")).select("n").scalar()
    keep = ["doc_id", "digest"]
    raw = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("body"))
    texts = raw.select(*keep, words_of(F.col("body")).alias("words"))
    bits_of = bitmap.select("bitmap").scalar()
    any_hit = F.lit(False)
    for i in range(len(masks)):
        any_hit = any_hit | F.coalesce(may_hold(bits_of, F.col(f"h{i}"), bits), F.lit(False))
    probes = _hashes(_windows(texts, keep, masks).where(any_hit), keep, len(masks))
    # Without short items no text is split for them.
    whole = (
        raw.where(F.size(lengths) > 0).select(*keep, words_of(F.col("body")).alias("words")).select(*keep, "words", F.explode(lengths).alias("n")).where(F.size("words") >= F.col("n"))
        .select(*keep, "words", "n", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("at"))
        .select(*keep, "at", F.xxhash64(-F.col("n"), F.array_join(F.slice("words", F.col("at") + 1, F.col("n")), " ")).alias("hash"))
    )
    lies = (
        probes.union(whole).where(may_hold(bits_of, F.col("hash"), bits)).join(index, "hash")
        .select(*keep, "item_id", "n_item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    )
    lies = stage(lies, "lies")
    hit = lies.select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest")).distinct()
    same_text = raw.join(
        hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest")), "left_semi")
    same_text = same_text.groupBy(*keep).agg(F.max("body").alias("body")).select(
        *keep, words_of(F.col("body")).alias("words"))
    item_words = items.select("item_id", F.col("words").alias("item_words"))
    # Of the text only the words beside the item travel on; where it begins ahead of the text, its
    # first words have none.
    ahead = F.least(F.col("shift"), F.lit(0))
    beside = F.slice("words", F.col("shift") - ahead + 1, F.greatest(F.col("n_item") + ahead, F.lit(0)))
    compared = (
        lies.join(same_text.select(F.col("doc_id").alias("d"), F.col("digest").alias("g"), "words"),
                  F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")))
        .select(*keep, "item_id", "n_item", "shift", beside.alias("words"))
        .join(item_words.withColumnRenamed("item_id", "i"), (F.col("n_item") == F.size("item_words")) & F.col("item_id").eqNullSafe(F.col("i")))
        .withColumn("o", _overlap(ahead, least_share))
        .withColumn("n_overlap", F.col("o.best_last") - F.col("o.best_first") + 1)
    )
    good = compared.where(
        (F.col("o.best_same") >= F.least(F.lit(least_words), F.col("n_item")))
        & (F.col("o.best_same") >= least_share * F.col("n_overlap")))
    best = good.groupBy(*keep, "item_id").agg(F.max(F.struct(
        F.col("o.best_same").alias("n_same"), (-F.col("n_overlap")).alias("fewer"),
        (-(F.col("shift") + F.col("o.best_first"))).alias("sooner"), "n_overlap", "n_item",
        (F.col("shift") + F.col("o.best_first")).alias("first_word"),
        (F.col("shift") + F.col("o.best_last")).alias("last_word"))).alias("b"))
    return best.select(
        *keep, "item_id", *[F.col(f"b.{c}").cast("long").alias(c) for c in ("n_same", "n_overlap", "n_item")],
        (F.col("b.n_same") / F.col("b.n_item")).alias("share"),
        *[F.col(f"b.{c}").cast("long").alias(c) for c in ("first_word", "last_word")])


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that share no verified overlap with the benchmark."""
    found = contaminations(docs, benchmark, doc_id, text).select("doc_id", "digest").distinct()
    found = stage(found, "contaminated")
    rows = docs.select(boxed(docs), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_digest"))
    return rows.join(
        found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_digest") == F.col("digest")), "left_anti",
    ).select("row.*")
