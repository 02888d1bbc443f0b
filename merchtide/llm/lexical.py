"""Ranked lexical search: documents grouped by which terms of an item they hold.

A pass over the corpus counts what the weights need. The next one ranks: each batch of documents
becomes a bitmap per term, and for each item the documents are split, term by term, into groups
with the same mask of matched terms. Groups are taken by the greatest score their mask allows;
an item is finished in a batch when no group left can reach its tenth place so far. Scores are
whole numbers, so results do not depend on how documents are dealt to tasks.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchtide.llm.common import first_of_each, prepared

MOST = 10
# Items are taken in blocks of so many bytes of text, each with its own passes over the corpus.
BLOCK_BYTES = 4 << 20
# ASCII letters and digits and all that is not ASCII belong to terms; upper case A to Z is folded.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, as UTF-8; none for a null text."""
    return text.encode("utf-8", "replace").translate(FOLD).split() if text else []


class Index:
    """A batch of documents as one bitmap per term, with what the term adds to each score."""

    def __init__(self, ids: list, counts: list[Counter], lengths: list[int], block: Block):
        self.ids = ids
        which, place, times = [], [], []
        for at, held in enumerate(counts):
            which.extend(held)
            times.extend(held.values())
            place.extend([at] * len(held))
        term, at, tf = (np.array(v, dtype=np.int64) for v in (which, place, times))
        norm = 25 + np.array([75 * n * block.n // block.total for n in lengths], dtype=np.int64)
        add = block.weight[term] * (10**9 * tf // (1000 * tf + 8 * norm[at]))
        # What each document gains from each of its terms, for the exact score.
        self.gain: list[dict[int, int]] = [{} for _ in ids]
        for t, a, g in zip(which, place, add.tolist()):
            self.gain[a][t] = g
        self.bits: dict[int, int] = {}
        self.best: dict[int, int] = {}
        order = np.argsort(term, kind="stable")
        term, at, add = term[order], at[order], add[order]
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        for begin, end in zip(starts, [*starts[1:], len(term)]):
            mask = np.zeros(len(ids), dtype=bool)
            mask[at[begin:end]] = True
            t = int(term[begin])
            self.bits[t] = int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little")
            self.best[t] = int(add[begin:end].max())

    def search(self, item: dict[int, int], top: list, most: int) -> int:
        """Put the documents that belong into ``top``; the number of masks evaluated."""
        held = sorted(((self.best[t] * times, t) for t, times in item.items() if t in self.bits), reverse=True)
        held = [(limit, t) for limit, t in held if limit > 0]
        any_term = 0
        for _, t in held:
            any_term |= self.bits[t]
        masks = 0
        # (negative limit, number, depth, documents): the limit is what the mask may score at most.
        queue = [(-sum(limit for limit, _ in held), 0, 0, any_term)] if any_term else []
        number = 0
        while queue:
            limit, _, depth, documents = heapq.heappop(queue)
            if len(top) == most and limit > top[-1][0]:
                break
            while depth < len(held):
                own, t = held[depth]
                depth += 1
                without = documents & ~self.bits[t]
                if without:
                    if limit + own < 0 and not (len(top) == most and limit + own > top[-1][0]):
                        number += 1
                        heapq.heappush(queue, (limit + own, number, depth, without))
                    documents ^= without
                    if not documents:
                        break
            if documents:
                masks += 1
                self._evaluate(documents, item, top, most)
        return masks

    def _evaluate(self, documents: int, item: dict[int, int], top: list, most: int) -> None:
        raw = np.frombuffer(documents.to_bytes((len(self.ids) + 7) // 8, "little"), dtype=np.uint8)
        for at in np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist():
            gain = self.gain[at]
            score = sum(gain[t] * times for t, times in item.items() if t in gain)
            if score > 0:
                doc_id = self.ids[at]
                entry = (-score, doc_id is not None, doc_id)
                if len(top) < most or entry < top[-1]:
                    insort(top, entry)
                    del top[most:]


class Block:
    """Some of the items: their terms as numbers, with the corpus counts once these are known."""

    def __init__(self, items: list[tuple]):
        self.ids = [item_id for item_id, _ in items]
        self.numbers: dict[bytes, int] = {}
        self.items = []
        for _, text in items:
            times = Counter(terms_of(text))
            self.items.append({self.numbers.setdefault(t, len(self.numbers)): c for t, c in times.items()})
        self.n = self.total = 0
        self.weight = np.zeros(len(self.numbers), dtype=np.int64)

    def learn(self, n: int, total: int, df: dict[int, int]) -> None:
        self.n, self.total = n, total
        for t, count in df.items():
            self.weight[t] = int(np.floor(1000 * np.log((2 * n + 2) / (2 * count + 1))))


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Block]:
    """The items in blocks of bounded size; the driver holds one at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append(tuple(row))
        size += len(row[1] or "")
        if size >= block_bytes:
            yield Block(held)
            held, size = [], 0
    if held:
        yield Block(held)


def _counts(docs: DataFrame, block: Block) -> None:
    """Count documents, terms and documents per term of the block over the whole corpus."""
    numbers = block.numbers

    def count(batches):
        n = total = 0
        df: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                words = terms_of(text)
                n += bool(words)
                total += len(words)
                df.update(numbers.keys() & set(words))
        yield pd.DataFrame({"term": [-1, -2], "value": [n, total]})
        yield pd.DataFrame({"term": [numbers[t] for t in df], "value": list(df.values())}, dtype="int64")

    rows = docs.select("text").mapInPandas(count, "term long, value long")
    # A row per term of the block, and two.
    found = {r["term"]: r["value"] for r in rows.groupBy("term").agg(F.sum("value").alias("value")).collect()}
    block.learn(found.pop(-1, 0), found.pop(-2, 0), found)


def _ranked(docs: DataFrame, block: Block, number: int, most: int, kinds: str) -> DataFrame:
    """The best documents of every item, ``most`` per task and item."""
    numbers = block.numbers

    def rank(batches):
        tops: list[list] = [[] for _ in block.items]
        for batch in batches:
            ids, counts, lengths = [], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = terms_of(text)
                held = Counter(numbers[w] for w in words if w in numbers)
                if held:
                    ids.append(None if pd.isna(doc_id) else doc_id)
                    counts.append(held)
                    lengths.append(len(words))
            if ids:
                index = Index(ids, counts, lengths, block)
                for item, top in zip(block.items, tops):
                    index.search(item, top, most)
        rows = [((number << 32) + at, block.ids[at], doc_id, -less)
                for at, top in enumerate(tops) for less, _, doc_id in top]
        if rows:
            yield pd.DataFrame(rows, columns=["item", "item_id", "doc_id", "score"], dtype=object)

    return docs.mapInPandas(rank, f"item long, {kinds}, score long")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    most: int = MOST, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``most`` best documents with a score above 0.

    The score is BM25 in whole numbers (k1 = 2, b = 0.75 over document lengths), equal scores go by
    ascending ``doc_id``, a null id first. A null or empty text has no terms: such a document is
    not found, such an item finds nothing. Every row counts for itself, so repeated rows are each
    ranked; empty tables give no rows. Other columns are not read. A text, however long, is one
    row of a batch and takes memory in proportion to itself.
    """
    spark = prepared(docs.sparkSession)
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    items = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    kinds = f"item_id {items.dtypes[0][1]}, doc_id {docs.dtypes[0][1]}"
    found = spark.createDataFrame([], f"item long, {kinds}, score long")
    for number, block in enumerate(_blocks(items, block_bytes)):
        _counts(docs, block)
        found = found.union(_ranked(docs, block, number, most, kinds))
    rows = found.withColumn("place", F.struct((-F.col("score")).alias("less"), "doc_id"))
    # The best of many tasks meet in lots first, so no task ranks more than a lot's share.
    best = first_of_each(rows, "item", "place", most)
    rank = F.row_number().over(Window.partitionBy("item").orderBy("place"))
    return best.select("item_id", rank.alias("rank"), "doc_id", "score")
