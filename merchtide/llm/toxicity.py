"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in its distinct vocabulary words and word beginnings
(an inflected or compound form then shares what its stem has taught); a document's is the
noisy-or of its sentences, 1 - prod(1 - p). Only document labels are learned from, the
sentence scores then say where the offence is.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.common import first_of_each, prepared
from merchtide.sources.storage import stage

# The model is fitted on at most this many labelled documents of each class, first in hash
# order, and on this many of their most telling words.
FIT_PER_CLASS = 3000
VOCABULARY = 2000
# A feature counts as telling when its likelihood ratio reaches this multiple of the logarithm of the
# number of features. Chance alone brings about the root of their number there, at any size; the
# penalty deals with these. (At 2 it would bring about one.)
EVIDENCE = 1.0
STEPS, RATE, PENALTY = 400, 0.1, 2e-4
THRESHOLD = 0.3

# Lengths of the word beginnings that count as features beside the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each piece between sentence marks and line ends."""
    return [m.span() for m in SENTENCE.finditer(text or "")]


def features(word: str) -> list[str]:
    """The word itself and its proper beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


@dataclass(frozen=True)
class Model:
    """A weight per feature and the bias every sentence starts from."""

    weights: dict[str, float]
    bias: float

    def sentence_logits(self, text: str | None) -> list[tuple[int, int, float]]:
        seen: dict[str, list[str]] = {}
        found = []
        for start, end in sentences(text):
            hits = set()
            for word in WORD.findall(text[start:end].lower()):
                if word not in seen:
                    seen[word] = [f for f in features(word) if f in self.weights]
                hits.update(seen[word])
            found.append((start, end, self.bias + sum(self.weights[f] for f in sorted(hits))))
        return found

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability and every sentence with its own."""
        found = self.sentence_logits(text)
        if not found:
            return 0.0, []
        z = np.array([f[2] for f in found])
        p = 1.0 / (1.0 + np.exp(-z))
        noisy_or = -np.expm1(-np.logaddexp(0.0, z).sum())
        return float(min(1.0, max(0.0, noisy_or))), [(s, e, float(v)) for (s, e, _), v in zip(found, p)]


def _fit_bags(bags: list[list[list[int]]], labels: np.ndarray, weight: np.ndarray, words: int) -> np.ndarray:
    """Weights and, last, the bias that minimise the weighted loss of the noisy-or (Adam).

    Sentences without a vocabulary word all look alike, so only their number is kept.
    """
    sentence_bag, word_sentence, word_id = [], [], []
    plain = np.zeros(len(bags))
    for b, bag in enumerate(bags):
        for ids in bag:
            if ids:
                word_sentence += [len(sentence_bag)] * len(ids)
                word_id += ids
                sentence_bag.append(b)
            else:
                plain[b] += 1
    sentence_bag = np.array(sentence_bag, np.int64)
    word_sentence, word_id = np.array(word_sentence, np.int64), np.array(word_id, np.int64)
    theta = np.zeros(words + 1)
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(word_sentence, theta[word_id], minlength=len(sentence_bag))
        soft = np.bincount(sentence_bag, np.logaddexp(0.0, z), minlength=len(bags))
        soft = np.maximum(soft + plain * np.logaddexp(0.0, theta[-1]), 1e-12)
        # Change of the loss with the bag's sum of softplus.
        pull = weight * np.where(labels == 1, -np.exp(-soft) / -np.expm1(-soft), 1.0)
        slope = pull[sentence_bag] / (1.0 + np.exp(-z))
        grad = np.empty_like(theta)
        grad[:-1] = np.bincount(word_id, slope[word_sentence], minlength=words) + PENALTY * theta[:-1]
        grad[-1] = slope.sum() + (pull * plain).sum() / (1.0 + np.exp(-theta[-1]))
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        toxic: str = "toxic", per_class: int = FIT_PER_CLASS, vocabulary: int = VOCABULARY,
        evidence: float = EVIDENCE) -> Model:
    """Fit on ``per_class`` documents of each label, chosen by a hash of the id.

    A document labelled twice counts as toxic if one label says so; null ids and labels
    teach nothing. Classes are weighted back to their true sizes. The vocabulary are the
    features whose presence says most about the label. With no documents, or with one class
    only, every score is the share of that class.
    """
    prepared(docs.sparkSession)
    known = (
        labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("label"))
    )
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().where("label in (0, 1)").collect()}
    chosen = first_of_each(known.withColumn("h", F.xxhash64("id")), "label", "h", per_class)
    # At most two times per_class ids, so the hint is safe at any size of the corpus.
    texts = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen.select("id", "label")), "id")
        .groupBy("id", "label").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    )

    @F.pandas_udf("array<string>")
    def present(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda t: sorted({f for w in set(WORD.findall(t.lower())) for f in features(w)}))

    texts = stage(texts, "labelled")
    counts = texts.select("label", F.explode(present("text")).alias("word")).groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("pos"), F.count("*").alias("n"),
    )
    drawn = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    pos, neg = drawn.get(1, 0), drawn.get(0, 0)
    if not pos or not neg:
        return Model({}, 20.0 if pos else -20.0)
    counts = stage(counts, "features")
    # The likelihood ratio of the feature's presence against the label; unlike chi-squared it does
    # not overrate a feature of one document.
    share = pos / (pos + neg)

    def part(seen: Column, due: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)

    n, with_pos = F.col("n").cast("double"), F.col("pos").cast("double")
    rest = pos + neg - n
    ratio = 2 * (part(with_pos, n * share) + part(n - with_pos, n * (1 - share))
                 + part(pos - with_pos, rest * share) + part(neg - n + with_pos, rest * (1 - share)))
    least = evidence * math.log(max(counts.count(), 1))
    top = counts.withColumn("ratio", ratio).where(F.col("ratio") >= least)
    words = [r["word"] for r in top.orderBy(F.desc("ratio"), "word").limit(vocabulary).collect()]
    number = {w: i for i, w in enumerate(words)}

    @F.pandas_udf("array<array<int>>")
    def bagged(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda t: [
            sorted({number[f] for w in set(WORD.findall(t[s:e].lower())) for f in features(w) if f in number})
            for s, e in sentences(t)])

    found = texts.select("id", "label", bagged("text").alias("bag")).collect()
    rows = sorted(((r["id"], r["label"], r["bag"]) for r in found), key=lambda r: r[0])
    target = np.array([r[1] for r in rows])
    weight = np.where(target == 1, sizes.get(1, pos) / pos, sizes.get(0, neg) / neg)
    theta = _fit_bags([bag for _, _, bag in rows], target, weight, len(words))
    return Model({w: float(t) for w, t in zip(words, theta[:-1])}, float(theta[-1]))


def scored(text: Column, model: Model, offending_at: float = 0.5) -> Column:
    """``struct(score, offending)`` of a text column.

    ``offending`` lists start, end (code points) and score of the sentences at or above
    ``offending_at``, worst first. A null or empty text has score 0 and no sentence.
    """

    @F.pandas_udf("score double, offending array<struct<start:long,end:long,score:double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            score, found = model.score(t)
            bad = sorted((f for f in found if f[2] >= offending_at), key=lambda f: (-f[2], f[0]))
            out.append((score, [{"start": s, "end": e, "score": p} for s, e, p in bad]))
        return pd.DataFrame(out, columns=["score", "offending"])

    return run(text)
