"""Packing to a fixed length with the mixture held in every window.

Each source is a queue of tokens. A round of deficit round-robin adds the queue's quantum, its
target share of a window, to its deficit and serves the whole tokens of it; the fraction is
carried to the next round. After ``w`` rounds a queue has thus served ``floor(w * quantum)`` of its
tokens, so the place of any token follows from its place in its queue alone: rounds need not be
played one after the other, and windows of one task carry on exactly where another's stopped.
Laid end to end, the rounds fill every window but the last; its bounds drift from those of the
rounds by less than one token a queue.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchtide.llm.common import prepared
from merchtide.sources.storage import stage

LENGTH = 2048
END_ID = 1
# Fractions of a token a quantum can hold, in bits: enough for 1.4e14 tokens in 64-bit numbers.
FRACTION = 16
# The sources with most characters have a queue each; all that are left share the last queue.
MOST_QUEUES = 1024
# Words with known ids a task remembers before it starts anew, and tokens it cuts at once.
MOST_WORDS, TOKENS_AT_ONCE = 600_000, 1 << 20
# Texts of these characters only are cut at white space and remembered by lower-case word; others
# go to the tokenizer whole. Below U+0130 lower case and composition work character by character.
UNUSUAL = re.compile("[\x1c-\x1fİ-\U0010ffff]")
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class Words(dict):
    """Ids by word; those of a word not known yet are found on the way."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.find(word)
        return found


class Encoder:
    """Ids of whole texts as packed numbers, the same as the tokenizer's own.

    ``by_word`` holds for tokenizers that drop white space, fold case, split words by ``PARTS`` and
    merge the bytes of a part, as ``word_bpe_49k.json`` does; without it nothing is assumed.
    """

    def __init__(self, path: str, by_word: bool = True):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.format = "H" if self.kind == "<u2" else "I"
        self.by_word = by_word
        self.known = Words(self._word)
        # How the tokenizer spells the bytes of a character.
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: spelled.pre_tokenize_str(chr(c))[0][0] for c in range(1, 0x130)}

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype=self.kind).tobytes()

    def _merged(self, part: str) -> bytes:
        spelled = part if part.isascii() and part.isalpha() else part.translate(self.spelled)
        found = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return struct.pack(f"<{len(found)}{self.format}", *found)

    def _word(self, word: str) -> bytes:
        if "<|" in word or "\0" in word:  # may be a special token
            return self._whole(word)
        if word.isalpha():
            return self._merged(word)
        parts = PARTS.findall(word)
        for part in parts:
            # A part of letters is a word of its own elsewhere.
            if part not in self.known:
                self.known[part] = self._merged(part)
        return b"".join([self.known[part] for part in parts])

    def encode(self, text: str) -> bytes:
        if not self.by_word or UNUSUAL.search(text):
            return self._whole(text)
        words = text.lower().split()
        known = self.known
        if len(known) + len(words) > MOST_WORDS:
            known.clear()
        return b"".join(map(known.__getitem__, words))


@lru_cache(maxsize=1)
def encoder_of(path: str, by_word: bool) -> Encoder:
    """The encoder of this process: a task goes on with the words that earlier ones have met."""
    return Encoder(path, by_word)


def _queues(docs: DataFrame, most: int) -> DataFrame:
    """``(queue_source, queue)`` of the sources with most characters, ``most - 1`` at most."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size"))
    largest = sizes.orderBy(F.desc("size"), "source").limit(most - 1)
    spot = F.row_number().over(Window.orderBy(F.desc("size"), "source")) - 1
    return largest.select(F.col("source").alias("queue_source"), spot.alias("queue"))


def _tokenised(docs: DataFrame, path: str, end_id: int, by_word: bool) -> DataFrame:
    """``(part, queue, before, doc_id, n, ids)``: ``before`` are the tokens of the queue in this part."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        encoder = encoder_of(path, by_word)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        width = len(end)
        part = TaskContext.get().partitionId()
        held: dict[int, int] = {}
        for batch in batches:
            ids = [(encoder.encode(t) if t else b"") + end for t in batch["text"]]
            before = []
            for queue, own in zip(batch["queue"], ids):
                before.append(held.get(queue, 0))
                held[queue] = before[-1] + len(own) // width
            yield pd.DataFrame({
                "part": part, "queue": batch["queue"], "before": before, "doc_id": batch["doc_id"],
                "n": [len(own) // width for own in ids], "ids": ids})

    return docs.select("queue", "doc_id", "text").mapInPandas(
        encode, f"part int, queue int, before long, doc_id {kind}, n long, ids binary")


def quanta(totals: list[int], weights: list[float] | None, length: int = LENGTH) -> list[int]:
    """What each queue gains a round, in fractions of a token.

    Without weights, each its share of all tokens, so that all queues last to the end.
    """
    weights = [max(w, 0) for w in weights] if weights else totals
    whole = sum(weights)
    return [max(1, -int(-w * (length << FRACTION) // whole)) if whole else 1 for w in weights]


def places(
    queue: np.ndarray, first: np.ndarray, n: np.ndarray, totals: list[int], quantum: list[int], length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents with ``n`` tokens from ``first`` on in their ``queue``.

    Four arrays: the number of the document, where the piece starts in it, its tokens, and its
    place when all rounds are laid end to end. A piece ends where a round or a sequence does.
    """
    document = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(document)) - np.repeat(np.cumsum(n) - n, n)
    at = start + first[document]
    # The round in which a token is served: the first after which the queue has served more.
    rounds = -(-((at + 1) << FRACTION) // np.array(quantum)[queue[document]]) - 1
    opens = np.append(True, (rounds[1:] != rounds[:-1]) | (document[1:] != document[:-1]))
    runs = np.flatnonzero(opens)
    size = np.diff(np.append(runs, len(document)))
    document, start, at, rounds = document[runs], start[runs], at[runs], rounds[runs]
    own = queue[document]
    place = at - np.minimum(rounds * np.array(quantum)[own] >> FRACTION, np.array(totals)[own])
    for other, (total, gain) in enumerate(zip(totals, quantum)):
        # Queues before this one have had their turn of the round already.
        place += np.minimum((rounds + (other < own)) * gain >> FRACTION, total)
    # A run is no longer than a sequence, so it crosses one bound at most.
    room = length - place % length
    over = size > room
    twice = np.repeat(np.arange(len(size)), 1 + over)
    second = np.append(False, twice[1:] == twice[:-1])
    shift = np.where(second, room[twice], 0)
    size = np.where(second, size[twice] - shift, np.minimum(size, room)[twice])
    document, start, place = document[twice], start[twice] + shift, place[twice] + shift
    # Runs that touch within a sequence are one piece.
    apart = (document[1:] != document[:-1]) | (place[1:] != place[:-1] + size[:-1]) | (place[1:] % length == 0)
    first_runs = np.flatnonzero(np.append(True, apart))
    return document[first_runs], start[first_runs], np.add.reduceat(size, first_runs), place[first_runs]


def _cut(rows: DataFrame, kind: str, totals: list[int], quantum: list[int], length: int) -> DataFrame:
    """The pieces of all documents, cut where rounds and sequences end."""

    def lots(batch):
        """Rows of a bounded number of tokens, one at least."""
        bound = batch["n"].cumsum() // TOKENS_AT_ONCE
        for _, lot in batch.groupby(bound, sort=False):
            yield lot

    def cut(batches):
        for batch in batches:
            for lot in lots(batch):
                n, bodies = lot["n"].to_numpy(), lot["ids"].tolist()
                document, start, size, place = places(
                    lot["queue"].to_numpy(), (lot["base"] + lot["before"]).to_numpy(), n, totals, quantum, length)
                width = [len(body) // count for body, count in zip(bodies, n.tolist())]
                ids = [np.frombuffer(body, f"<u{w}").astype("<u4").tobytes() for body, w in zip(bodies, width)]
                yield pd.DataFrame({
                    "sequence_id": place // length, "offset": place % length,
                    "doc_id": lot["doc_id"].iloc[document].reset_index(drop=True),
                    "start": start, "length": size, "doc_tokens": n[document],
                    "ids": [ids[d][4 * s:4 * e] for d, s, e in zip(
                        document.tolist(), start.tolist(), (start + size).tolist())]})

    return rows.mapInPandas(
        cut, f"sequence_id long, offset long, doc_id {kind}, start long, length long, doc_tokens long, ids binary")


def pack(
    docs: DataFrame, tokenizer: str, weights: Mapping[str | None, float] | None = None, end_id: int = END_ID,
    length: int = LENGTH, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    by_word: bool = True, most_queues: int = MOST_QUEUES,
) -> DataFrame:
    """``(sequence_id, tokens, pieces)``: sequences of ``length`` tokens, each near the target mixture.

    ``tokens`` holds the ids as little-endian 32-bit numbers; ``pieces`` names the document, its
    tokens in all, where the piece starts in it, and its length and offset in the sequence. Each
    document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Only the last
    sequence is shorter. ``weights`` are target shares by source (a source left out has the
    least possible); a source that runs out leaves its part to the others. Without them the
    target is each source's share of all tokens. A null source is a source; sources beyond the
    ``most_queues - 1`` with most characters share a queue. Every row counts for itself, repeated rows
    and null ids too; empty tables give no rows; other columns are not read. A text is one row,
    so its ids must fit in memory.
    """
    spark = prepared(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").alias("text"))
    kind = rows.dtypes[0][1]
    queues = stage(_queues(rows, most_queues), "queues")
    names = {r["queue"]: r["queue_source"] for r in queues.collect()}
    # At most ``most_queues`` rows, so the broadcast has a bound.
    dealt = rows.join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("queue_source")), "left").select(
        "doc_id", "text", F.coalesce("queue", F.lit(len(names))).alias("queue"))
    tokenised = stage(_tokenised(dealt, tokenizer, end_id, by_word), "tokens")
    held = stage(tokenised.groupBy("queue", "part").agg(F.sum("n").alias("held")), "held")
    totals = [0] * (len(names) + 1)
    for r in held.groupBy("queue").agg(F.sum("held").alias("held")).collect():
        totals[r["queue"]] = r["held"]
    shares = [weights.get(names.get(q), 0.0) for q in range(len(totals))] if weights else None
    # A row per part of the input and queue; a queue's rows meet in one task.
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("queue", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    pieces = _cut(tokenised.join(base, ["queue", "part"]), kind, totals, quanta(totals, shares, length), length)
    laid = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "doc_id", "start", "length", "doc_tokens", "ids"))).alias("laid"))
    tokens = F.aggregate("laid", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return laid.select("sequence_id", tokens.alias("tokens"), F.transform("laid", lambda p: p.dropFields("ids")).alias("pieces"))


def piece_crc(tokens: Column, piece: Column) -> Column:
    """The checksum of a piece's ids, read from the tokens of its sequence."""
    return F.crc32(F.substring(tokens, (piece["offset"] * 4 + 1).cast("int"), (piece["length"] * 4).cast("int")))
