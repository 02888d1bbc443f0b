"""Spelling variants: a dictionary of trie-node pairs.

The words go into two tries, one of the words and one of the words reversed, whose nodes are
numbered. A word cut at a place is then two integers, the node of what stands before and the node of
what stands after. Leaving one letter out at a place gives such a pair too. Words with equal pairs,
both left out, differ by a replaced letter; a word that is cut where another left a letter out
lacks that letter. Every neighbour at distance one meets in a pair, and nothing else does.

The tries are numbered over sorted lots of words: a node that two lots share lies on the path
to the last word of one and the first word of the next, and only these few are numbered ahead.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from os.path import commonprefix

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.common import prepared
from merchtide.sources.storage import stage

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT = 5, 3
# One in so many runs of a document, by checksum, loses a letter.
TYPO_ONE_IN = 97
# A form stands in at least so many times the places of its variant.
FORM_TIMES = 2
# Words of a sorted lot, which one task numbers; words a task counts before it passes them on.
LOT_WORDS, HELD_WORDS = 50_000, 200_000
# What numbers of one lot's nodes and words stay below.
LOT_BITS = 40


def words_of(doc_id: str, text: str) -> Counter:
    """The runs of a text in lower case, with a letter left out where the checksum says so."""
    start = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    # Bytes fold A to Z and nothing else.
    for run, times in Counter(RUN.findall(text.encode().lower().decode())).items():
        digest = zlib.crc32(run.encode(), start)
        if digest % TYPO_ONE_IN == 0:
            at = digest % len(run)
            run = run[:at] + run[at + 1:]
        found[run] += times
    return found


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: the words long and frequent enough, with their occurrences in all documents."""

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for own, body in zip(batch["doc_id"], batch["text"]):
                for word, times in words_of(own, body).items():
                    if len(word) >= LEAST_LENGTH:
                        held[word] += times
                if len(held) >= HELD_WORDS:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = docs.where(F.col(f"`{text}`").isNotNull()).select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    counted = rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _shared(a: str, b: str) -> int:
    return len(commonprefix([a, b]))


def shared_paths(bounds: list[tuple[int, str, str]]) -> dict[int, tuple[list[int], list[int]]]:
    """Numbers of the nodes that sorted lots share, from ``(lot, first word, last word)`` in order.

    For each lot those along its first word, shared with the lots before, and those along its
    last word, shared with the lots after; the first number of both is the root's.
    """
    paths = {}
    number = 0
    head, held = [0], [0]
    for at, (lot, first, last) in enumerate(bounds):
        deep = _shared(last, bounds[at + 1][1]) if at + 1 < len(bounds) else 0
        # Nodes on both paths keep their number.
        held = head[:_shared(first, last) + 1]
        tail = held[:deep + 1]
        for _ in range(len(tail), deep + 1):
            number += 1
            tail.append(number)
        paths[lot] = (head, tail)
        head = tail
    return paths


def node_paths(words: list[str], head: list[int], tail: list[int], first_number: int) -> list[list[int]]:
    """The node numbers along each of the sorted ``words``, root first."""
    number = first_number
    last = words[-1]
    paths, path, before = [], head, words[0][:len(head) - 1]
    for word in words:
        keep = _shared(before, word)
        path = path[:keep + 1]
        # Nodes on the way to the last word may be shared with the next lot.
        ahead = min(_shared(word, last), len(tail) - 1) if word[:keep + 1] == last[:keep + 1] else 0
        path = path + tail[keep + 1:ahead + 1]
        fresh = len(word) + 1 - len(path)
        path = path + list(range(number, number + fresh))
        number += fresh
        paths.append(path)
        before = word
    return paths


def _numbered(words: DataFrame, lots: int, label: str) -> DataFrame:
    """``(id, word, own, nodes)`` of ``(word, own)``: ``id`` follows the order of the words."""
    dealt = stage(words.repartitionByRange(lots, "word").select(
        "word", "own", F.spark_partition_id().alias("lot")), f"{label}-lots")
    bounds = dealt.groupBy("lot").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    # Two words of each lot.
    paths = shared_paths([tuple(r) for r in bounds.orderBy("lot").collect()])

    def number(lot: pd.DataFrame) -> pd.DataFrame:
        lot = lot.sort_values("word", ignore_index=True)
        at = int(lot.at[0, "lot"])
        start = (at + 1) << LOT_BITS
        nodes = node_paths(lot["word"].tolist(), *paths[at], start)
        return pd.DataFrame({
            "id": range(start, start + len(lot)), "word": lot["word"], "own": lot["own"], "nodes": nodes})

    return stage(dealt.groupBy("lot").applyInPandas(
        number, "id long, word string, own long, nodes array<long>"), label)


def _pairs(words: DataFrame) -> DataFrame:
    """``(before, after, kind, x)``: every word cut at every place (kind 0) and with each letter left out.

    Left out of a run of equal letters, only the first (kind 1, then 2) gives a new word.
    """
    size = F.size("letters")
    cut = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("nodes", i).alias("before"), F.get("back", size - i).alias("after"), F.lit(0).alias("kind")))
    left = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("nodes", i).alias("before"), F.get("back", size - i - 1).alias("after"),
        F.when((i > 0) & (F.get("letters", i) == F.get("letters", i - 1)), 2).otherwise(1).alias("kind")))
    # Ordered by count, then by word from the last to the first, the greatest is the best.
    best = F.struct("n", (-F.col("id")).alias("less"))
    return words.select(best.alias("x"), F.explode(F.concat(cut, left)).alias("p")).select("p.*", "x")


def _nearest(pairs: DataFrame) -> DataFrame:
    """``(id, n_near, best)`` of every word with a near one.

    A pair holds one whole word at most and a word per letter that can be left out, so its rows are
    bounded by the alphabet. It says for each of its words how many near it, and the best of these.
    """
    held = pairs.groupBy("before", "after").agg(
        F.max(F.when(F.col("kind") == 0, F.col("x"))).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("kind") > 0, F.struct("x", "kind"))), asc=False).alias("left"))
    held = held.where((F.size("left") > 1) | ((F.size("left") == 1) & F.col("whole").isNotNull()))
    size, fresh = F.size("left"), F.filter("left", lambda m: m["kind"] == 1)

    def row(x: Column, n: Column, best: Column) -> Column:
        return F.struct((-x["less"]).alias("id"), n.cast("long").alias("n"), best.alias("best"))

    def member(m: Column, at: Column) -> Column:
        whole = F.when(m["kind"] == 1, F.col("whole"))
        other = F.when(at == 0, F.get("left", F.lit(1))["x"]).otherwise(F.get("left", F.lit(0))["x"])
        return row(m["x"], size - 1 + F.when(whole.isNotNull(), 1).otherwise(0), F.greatest(other, whole))

    rows = F.concat(
        F.transform("left", member),
        F.when(F.col("whole").isNotNull(), F.array(row(F.col("whole"), F.size(fresh), F.get(fresh, F.lit(0))["x"])))
        .otherwise(F.array()))
    rows = held.select(F.explode(rows).alias("r")).select("r.*").where(F.col("n") > 0)
    return rows.groupBy("id").agg(F.sum("n").alias("n_near"), F.max("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """``(id, root)`` from ``(id, form)``: each round doubles how far a word sees.

    Counts at least double along a chain, so it has no more links than a count has bits.
    """
    seen = stage(links.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not seen.where("moved").isEmpty():
        ahead = seen.select(F.col("id").alias("root"), F.col("root").alias("next"))
        seen = stage(seen.join(ahead, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return seen.select("id", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lot_words: int = LOT_WORDS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of the corpus.

    ``form`` is the near word of largest count, ties the smallest in code-point order, if it
    stands in at least ``FORM_TIMES`` times as many places; ``root`` is where the forms end. A null text has no
    words, a null id counts as empty. Repeated rows count again; empty tables give no rows; other
    columns are not read. A word of any length takes memory in proportion to itself.
    """
    prepared(docs.sparkSession)
    words = stage(word_counts(docs, doc_id, text), "words")
    lots = max(1, -(-words.count() // lot_words))
    forward = _numbered(words.select("word", F.col("n").alias("own")), lots, "forward").withColumnRenamed("own", "n")
    backward = _numbered(forward.select(F.reverse("word").alias("word"), F.col("id").alias("own")), lots, "backward")
    both = forward.join(backward.select(F.col("own").alias("id"), F.col("nodes").alias("back")), "id")
    near = _nearest(_pairs(both.select("id", "n", F.split("word", "").alias("letters"), "nodes", "back")))
    best = F.when(F.col("best.n") >= FORM_TIMES * F.col("n"), F.col("best"))
    known = stage(forward.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-best["less"]).alias("form"), best["n"].alias("form_n")), "near")
    linked = known.where(F.col("form").isNotNull())
    names = known.select("id", "word")
    ends = linked.join(_roots(linked.select("id", "form")), "id")
    ends = ends.join(names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
    ends = ends.join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    columns = ["word", "n", "n_near", "form_n"]
    alone = known.where(F.col("form").isNull())
    return ends.select(*columns, F.col("form_word").alias("form"), F.col("root_word").alias("root")).union(
        alone.select(*columns, F.lit(None).cast("string"), "word"))
