"""License statements by an exact set-similarity join of text blocks with templates.

A block (a line, or as many words in a row as the template has, wherever lines break) matches a
template when it holds at least ``threshold`` of the template's distinct words. All words are put in one order, rarest in the corpus first. A matching block
must then hold one of the template's first ``n - need + 1`` words (prefix filter), must have
``need`` words (length filter), and from the first common word on both must have enough words
left (positional filter). What remains is counted out.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.common import prepared

THRESHOLD = 0.8
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases whose words stand one after another, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening sentences of common licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by": "This work is licensed under a Creative Commons Attribution License",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of "
           "the GNU General Public License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
           "without fee is hereby granted",
    "lgpl": "under the terms of the GNU Lesser General Public License",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain": "This is free and unencumbered software released into the public domain",
}


def words_of(text: str) -> list[str]:
    """Words after lower-casing A to Z only."""
    return WORD.findall(text.encode().lower().decode())


@dataclass(frozen=True)
class Index:
    """Templates as words in the global order, with the prefix words that lead to them."""

    rank: dict[str, int]
    need: dict[str, int]
    ordered: dict[str, list[str]]
    prefix: dict[str, list[tuple[str, int]]]
    length: dict[str, int]

    def matches(self, block: set[str]) -> dict[str, float]:
        """Template name to the share of its words that the block holds."""
        hits = block & self.prefix.keys()
        if not hits:
            return {}
        known = sorted(self.rank[w] for w in block if w in self.rank)
        first: dict[str, tuple[int, int]] = {}
        for word in sorted(hits, key=self.rank.__getitem__):
            for name, at in self.prefix[word]:
                first.setdefault(name, (at, self.rank[word]))
        found = {}
        for name, (at, rank) in first.items():
            template, need = self.ordered[name], self.need[name]
            if len(block) < need:  # length
                continue
            left = sum(r >= rank for r in known)
            if min(len(template) - at, left) < need:  # position
                continue
            share = len(block.intersection(template)) / len(template)
            if share * len(template) >= need:
                found[name] = share
        return found


    def windows(self, words: list[str]) -> list[tuple[str, int, int, float]]:
        """Template, first word, number of words and share of the matches in sliding windows.

        A window has the template's length in words. Of windows that overlap, the best counts.
        """
        known = [(at, w) for at, w in enumerate(words) if w in self.rank]
        held = {w for _, w in known}
        found = []
        for name in sorted({n for w in held & self.prefix.keys() for n, _ in self.prefix[w]}):
            template, need, length = set(self.ordered[name]), self.need[name], self.length[name]
            if len(held & template) < need:
                continue
            own = [(at, w) for at, w in known if w in template]
            inside: Counter[str] = Counter()
            left, best, until = 0, None, -1
            for at, word in own:
                inside[word] += 1
                while own[left][0] <= at - length:
                    gone = own[left][1]
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                    left += 1
                if len(inside) < need:
                    continue
                first = own[left][0]
                match = (name, first, at - first + 1, len(inside) / len(template))
                if best and first > until:
                    found.append(best)
                    best = None
                if best is None or match[3] > best[3]:
                    best = match
                until = at
            if best:
                found.append(best)
        return found


def build_index(frequency: dict[str, int], templates: dict[str, str], threshold: float) -> Index:
    order = {}
    for name, text in templates.items():
        for word in words_of(text):
            order[word] = (frequency.get(word, 0), word)
    rank = {w: i for i, w in enumerate(sorted(order, key=order.__getitem__))}
    ordered = {n: sorted(set(words_of(t)), key=rank.__getitem__) for n, t in templates.items()}
    need = {n: max(1, ceil(threshold * len(ws) - 1e-9)) for n, ws in ordered.items()}
    prefix: dict[str, list[tuple[str, int]]] = {}
    for name, ws in ordered.items():
        for at, word in enumerate(ws[:len(ws) - need[name] + 1]):
            prefix.setdefault(word, []).append((name, at))
    return Index(rank, need, ordered, prefix, {n: len(words_of(t)) for n, t in templates.items()})


def word_frequency(docs: DataFrame, text: str, templates: dict[str, str]) -> dict[str, int]:
    """In how many blocks of all documents each template word stands.

    Words outside the templates never meet one, so the result is as small as the templates.
    """
    vocabulary = frozenset(w for t in templates.values() for w in words_of(t))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for rows in batches:
            for body in rows["text"]:
                for line in body.split("\n"):
                    seen.update(vocabulary.intersection(words_of(line)))
        yield pd.DataFrame(seen.items(), columns=["word", "n"])

    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    rows = texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}


def scan(text: str | None, index: Index, phrases: dict[str, str]) -> dict:
    """Everything found in one text."""
    words: list[str] = []
    blocks = []
    starts = []
    for number, line in enumerate((text or "").split("\n")):
        own = words_of(line)
        starts.append(len(words))
        for name, share in sorted(index.matches(set(own)).items()):
            blocks.append({"line": number, "first_word": len(words), "n_words": len(own),
                           "template": name, "containment": share})
        words += own
    lines = {}
    for b in blocks:
        lines.setdefault(b["template"], []).append((b["first_word"], b["first_word"] + b["n_words"]))
    for name, first, n, share in index.windows(words):
        # What a line of its own has given already is not counted again; lines come in order.
        there = lines.get(name, ())
        at = bisect_left(there, first + n, key=lambda x: x[0]) - 1
        if at < 0 or there[at][1] <= first:
            blocks.append({"line": bisect_right(starts, first) - 1, "first_word": first, "n_words": n,
                           "template": name, "containment": share})
    joined = f" {' '.join(words)} "
    places, labels = [], set()
    for phrase, label in phrases.items():
        at, before, place = joined.find(f" {phrase} "), 0, 0
        while at >= 0:
            place += joined.count(" ", before, at)
            places.append(place)
            labels.add(label)
            at, before = joined.find(f" {phrase} ", at + 1), at
    score = 1.0 if labels else max((b["containment"] for b in blocks), default=0.0)
    return {
        "n_words": len(words), "n_base": len(places),
        "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(labels)),
        "labels": ",".join(sorted(labels | {b["template"] for b in blocks})),
        "score": score, "blocks": blocks,
    }


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, blocks array<struct<line:long,first_word:long,n_words:long,template:string,containment:double>>"
)


def scanned(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
            threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> Column:
    """A column with all that ``scan`` finds in ``text``; the word order is counted over ``docs`` now.

    A null text counts as empty: no words, no labels, score 0, null places. Rows are looked
    at one by one, so repeated rows and other columns make no difference.
    """
    prepared(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    index = build_index(word_frequency(docs, text, templates), templates, threshold)

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([scan(t, index, phrases) for t in texts],
                             columns=[c.split()[0] for c in RESULT.split(", ")])
        for name in ("first_word", "last_word"):
            found[name] = found[name].astype("Int64")
        return found

    return run(F.col(text))
