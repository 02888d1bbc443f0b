"""Language of a text by the nearest of several TF-IDF n-gram centroids per language."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.common import first_of_each, prepared
from merchtide.sources.storage import stage

UNKNOWN = "und"
# Hashed n-gram dimensions; n-grams are 1 to 3 characters of letters and word ends.
DIMENSIONS = 1 << 13
NGRAMS = (1, 2, 3)
# The model is fitted on at most this many labelled texts of a language, first in hash order.
FIT_PER_LANGUAGE = 600
CENTROIDS = 4
ROUNDS = 15
# A text is rejected when its similarity is below this share of the least similarity that a
# fitted text of the language has.
REJECT_FACTOR = 0.5
# So many picks, a short name and a hash each, are sent to all executors.
BROADCAST_PICKS = 1 << 18
# Characters turned into n-grams at once, so that a very long text needs bounded memory.
CHARACTERS_AT_ONCE = 1 << 20

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point whether it is a letter; made once per process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool))
    return _LETTERS[0]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of the n-grams of the letters, or None for a text without a letter."""
    counts = np.zeros(DIMENSIONS)
    seen = False
    text = text or ""
    end = np.zeros(1, np.uint32)
    # The last characters of a piece go ahead of the next, so that no n-gram is cut.
    carried = end[:0]
    for at in range(0, len(text), CHARACTERS_AT_ONCE):
        piece = text[at:at + CHARACTERS_AT_ONCE].lower()
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        seen |= bool(letter.any())
        last = at + CHARACTERS_AT_ONCE >= len(text)
        line = np.concatenate((carried if at else end, np.where(letter, points, 0).astype(np.uint32), end if last else end[:0]))
        line = line[np.concatenate(([True], (line[1:] > 0) | (line[:-1] > 0)))]
        for n in NGRAMS:
            # Those that end among the carried characters are counted.
            grams = line[max(0, len(carried) - n + 1):]
            code = np.full(max(0, len(grams) - n + 1), n, np.uint32)
            for k in range(n):
                code = (code ^ grams[k:k + len(code)]) * np.uint32(2654435761)
                code ^= code >> np.uint32(15)
            counts += np.bincount(code & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
        carried = line[-(max(NGRAMS) - 1):]
    return counts if seen else None


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _clustered(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from rows that are far from each other, so runs agree."""
    centres = [_unit(rows.mean(axis=0, keepdims=True))[0]]
    for _ in range(min(k, len(rows)) - 1):
        centres.append(rows[np.argmin((rows @ np.array(centres).T).max(axis=1))])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        own = np.argmax(rows @ centres.T, axis=1)
        moved = np.array([rows[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        moved = _unit(moved)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


@dataclass(frozen=True)
class Model:
    """Centroids with their languages, n-gram weights, and the least similarity per centroid."""

    languages: list[str]
    centroids: np.ndarray
    weights: np.ndarray
    floors: np.ndarray

    def predict(self, texts: Iterator[str | None]) -> pd.DataFrame:
        texts = list(texts)
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True})
        if not self.languages:
            return out
        for at in range(0, len(texts), 256):
            counts = [ngram_counts(t) for t in texts[at:at + 256]]
            known = [i for i, c in enumerate(counts) if c is not None]
            if not known:
                continue
            rows = _unit(np.log1p(np.array([counts[i] for i in known])) * self.weights)
            near = rows @ self.centroids.T
            best = near.argmax(axis=1)
            score = near[np.arange(len(best)), best]
            where = at + np.array(known)
            out.loc[where, "lang_pred"] = [self.languages[b] for b in best]
            out.loc[where, "score"] = np.clip(score, 0.0, 1.0)
            out.loc[where, "rejected"] = score < self.floors[best]
        return out


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = FIT_PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Fit on ``per_language`` texts of each non-null language, chosen by a hash of id and text.

    The tasks turn the chosen texts into n-gram counts, so the driver gets a bounded number
    of bounded vectors a language, 20 MB for each; the number of languages is taken to be that of
    human ones. Texts without a letter teach nothing. No texts at all give a model
    that knows no language.
    """
    prepared(docs.sparkSession)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("h"))
    # Only hashes are ranked; the texts are fetched for the few that were chosen.
    picked = stage(first_of_each(known.select("lang", "h").distinct(), "lang", "h", per_language), "picked")
    # Few picks go to the texts; with very many languages both sides are shuffled.
    few = picked.count() <= BROADCAST_PICKS
    chosen = known.join(F.broadcast(picked) if few else picked, ["lang", "h"]).groupBy("lang", "h").agg(F.max("text").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for language, body in zip(rows["lang"], rows["text"]):
                counts = ngram_counts(body)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    found.append((language, at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes()))
            yield pd.DataFrame(found, columns=["lang", "at", "n"])

    rows = chosen.select("lang", "text").mapInPandas(count, "lang string, at binary, n binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["at"], r["n"]))
    table = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, r in enumerate(rows):
        table[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<f4")
    weights = (np.log((1 + len(rows)) / (1 + np.count_nonzero(table, axis=0))) + 1.0).astype(np.float32)
    np.log1p(table, out=table)
    table *= weights
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
    labels = np.array([r["lang"] for r in rows], object)
    languages, centres, floors = [], [], []
    for language in sorted(set(labels)):
        own = table[labels == language]
        found = _clustered(own, centroids)
        languages += [language] * len(found)
        centres += list(found)
        floors += [REJECT_FACTOR * float((own @ found.T).max(axis=1).min())] * len(found)
    return Model(languages, np.array(centres, np.float32).reshape(len(languages), DIMENSIONS),
                 weights, np.array(floors))


def predicted(text: Column, model: Model) -> Column:
    """``struct(lang_pred, score, rejected)`` of a text column.

    A null text or one without a letter is ``und`` with score 0 and rejected, and so is
    every text when the model knows no language.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        return model.predict(texts)

    return run(text)
