"""Vectors and matches against plain Python."""

import hashlib
import math

from pyspark.sql import functions as F

from merchtide.functions import text as tx
from merchtide.operators import vectors
from merchtide.operators.vectors import vectorize, with_mentions, with_nearest
from merchtide.plans import sla


def plain_vector(text, dim=32):
    for mark in ",._-":
        text = text.replace(mark, " ")
    counts = [0.0] * dim
    for word in text.lower().split():
        digest = hashlib.md5(word.encode()).hexdigest()
        counts[int(digest[:8], 16) % dim] += -1 if int(digest[8:10], 16) % 2 else 1
    norm = math.sqrt(sum(c * c for c in counts))
    return [round(c / norm, 6) if norm else c for c in counts]


TEXTS = ["", "  ,. ", "Hot-ring_set, hot ring.", "tab\tand em　space\x1cend\xa0x", "é É ü"]


def test_both_forms_equal_plain_python(spark, data):
    docs = data.raw("documents").select("doc_id", "text")
    odd = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    both = docs.unionByName(odd)
    expected = {r.doc_id: plain_vector(r.text) for r in both.collect()}
    long_way = {r.doc_id: r.vector for r in vectorize(both, "doc_id", "text").collect()}
    assert long_way == expected
    short = odd.select("doc_id", tx.hashed_vector(F.col("text")).alias("vector")).collect()
    assert {r.doc_id: r.vector for r in short} == {k: v for k, v in expected.items() if k < 0}


def nearest_by_loop(events, kb, top):
    out = {}
    for key, vector in events:
        scored = [(round(sum(a * b for a, b in zip(vector, v)), 4), k) for k, v in kb]
        best = sorted(scored, key=lambda s: (-s[0], s[1]))[:top]
        out[key] = [(k, s) for s, k in best]
    return out


def test_nearest_does_not_depend_on_blocks(spark, data):
    docs = vectorize(data.raw("documents"), "doc_id", "text")
    items = vectorize(data.raw("benchmark"), "item_id", "text")
    # Two copies of an item tie everywhere.
    items = items.unionByName(items.filter("item_id < 3").withColumn("item_id", F.col("item_id") + 900))
    expected = nearest_by_loop(
        [tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], 3)
    for block_bytes in (1 << 20, 1 << 11):
        found = with_nearest(
            docs, "doc_id", "vector", items, "item_id", "vector", top=3, block_bytes=block_bytes)
        got = {
            r.doc_id: [(m.entry.item_id, m.score) for m in r.matches] for r in found.collect()
        }
        assert got == expected


def test_match_bonus(spark):
    kb = sla.vectorized_knowledge(sla.starter_knowledge(spark))
    found = spark.createDataFrame(
        [("B1", "HIGH", ["stock_reconciliation"], [("stock_reconciliation", "LATE", 5.0, "feed", "late")]),
         ("B2", "LOW", [], [])],
        f"batch_id string, risk_level string, processes array<string>, degraded_processes {sla.DEGRADED_TYPE}")
    results = []
    for block_bytes in (1 << 20, 1 << 9):
        rows = sla.with_knowledge(found, kb, block_bytes=block_bytes).collect()
        results.append({r.batch_id: [(m.entry.kb_id, m.score) for m in r.matches] for r in rows})
    assert results[0] == results[1]
    text = "B1 HIGH stock_reconciliation stock_reconciliation feed late"
    own = {r.kb_id: r.embedding_vector for r in kb.collect()}["KB05"]
    likeness = sum(a * b for a, b in zip(plain_vector(text), own))
    assert results[0]["B1"][0] == ("KB05", round(likeness + 0.25 + 0.40, 4))


def test_keyword_context_keeps_every_match(spark):
    kb = spark.createDataFrame(
        [(1, "slow_cluster", "scale up"), (2, "late_file", "ask upstream"), (3, "slow_join", "split")],
        "pos int, name string, fix string")
    events = spark.createDataFrame(
        [("a", "A SLOW day, file missing"), ("b", "all fine"), ("c", None)], "id string, t string")
    for block_bytes in (1 << 20, 1):
        rows = sla.with_context(events, "id", "t", kb, "name", "fix", "pos", block_bytes=block_bytes).collect()
        got = {r.id: r.context for r in rows}
        assert got["a"] == "[slow_cluster]: scale up\n[late_file]: ask upstream\n[slow_join]: split"
        assert got["b"] == got["c"] == sla.model.NO_CONTEXT


def test_nothing_to_match_is_an_empty_list(spark):
    schema = "id string, v array<double>"
    events = spark.createDataFrame([("a", [3.0, 0.0]), ("b", None)], schema)
    kb = spark.createDataFrame([("x", [2.0, 1.0]), ("y", None)], schema)
    for some, expected in ((kb, {"a": [(6.0, "x")], "b": []}), (kb.limit(0), {"a": [], "b": []})):
        rows = with_nearest(events, "id", "v", some, "id", "v").collect()
        assert {r.id: [(m.score, m.entry.id) for m in r.matches] for r in rows} == expected
    assert with_nearest(events.limit(0), "id", "v", kb, "id", "v").collect() == []


def test_mentions_of_odd_keys(spark):
    kb = spark.createDataFrame([(1, "a__b", "x"), (2, None, "y"), (3, "É_z", "z")], "pos int, name string, fix string")
    events = spark.createDataFrame([("e1", "nothing"), ("e2", None), ("e3", "ÉZ")], "id string, t string")
    rows = sla.with_context(events, "id", "t", kb, "name", "fix", "pos").collect()
    none = sla.model.NO_CONTEXT
    assert {r.id: r.context for r in rows} == {
        "e1": "[a__b]: x", "e2": none, "e3": "[a__b]: x\n[É_z]: z"}
    empty = sla.with_context(events, "id", "t", kb.limit(0), "name", "fix", "pos").collect()
    assert [r.context for r in empty] == [none] * 3


def test_mentions_equal_a_plain_search(spark, data):
    """Whole documents against words that contain each other, one of them nearly everywhere."""
    docs = data.raw("documents").select("doc_id", "text")
    texts = {r.doc_id: r.text and r.text.lower() for r in docs.collect()}
    some = sorted({w for t in list(texts.values())[:40] for w in (t or "").split()})[::7]
    named = [(i, [w, w[:3], w[1:]]) for i, w in enumerate(some)] + [(-1, ["a", "e", None]), (-2, None), (-3, [])]
    kb = spark.createDataFrame(named, "pos int, words array<string>")
    expected = {
        k: [] if t is None else sorted(p for p, ws in named if any(w is not None and w in t for w in ws or []))
        for k, t in texts.items()}
    for block_bytes in (1 << 24, 1 << 10):
        rows = with_mentions(docs, "doc_id", "text", kb, "pos", F.col("words"), block_bytes=block_bytes)
        assert {r.doc_id: [m.entry.pos for m in r.matches] for r in rows.collect()} == expected


def test_a_common_word_leaves_a_task_once_per_text():
    """Every entry has the same word: the task gives a row per text, not per text and entry."""
    import pyarrow as pa

    asked = pa.table({"key": list(range(1000)), "text": ["the one of the many"] * 1000})
    got = vectors._finder(asked, pa.table({"position": ["the", "man", "absent"]}))
    assert got.num_rows == 2000


def test_ties_keep_the_reference_order(spark):
    events = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(50)], "id int, v array<double>")
    kb = spark.createDataFrame(
        [(i, [float(i % 2), float(i % 5 == 0)]) for i in range(40)], "pos int, w array<double>")
    vecs = {r.pos: r.w for r in kb.collect()}
    for block_bytes in (1 << 24, 100):
        for top in (1, 3, 60):
            rows = with_nearest(events, "id", "v", kb, "pos", "w", top=top, block_bytes=block_bytes).collect()
            for r in rows:
                scored = sorted((-(r.v[0] * w[0] + r.v[1] * w[1]), p) for p, w in vecs.items())[:top]
                assert [(-m.score, m.entry.pos) for m in r.matches] == scored


def test_an_event_travels_once_however_small_the_blocks(spark, monkeypatch):
    events = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(30)], "id int, v array<double>")
    kb = spark.createDataFrame([(i, [float(i % 5), float(i % 3)]) for i in range(200)], "pos int, w array<double>")
    expected = nearest_by_loop([tuple(r) for r in events.collect()], [tuple(r) for r in kb.collect()], 1)
    met, meet = [], vectors._meet
    monkeypatch.setattr(vectors, "_meet", lambda *a: met.append(meet(*a)) or met[-1])
    # Then blocks so small that the set still goes in several.
    for most, travels in ((vectors.BLOCK_BYTES, 1), (1 << 10, 4)):
        monkeypatch.setattr(vectors, "BLOCK_BYTES", most)
        rows = with_nearest(events, "id", "v", kb, "pos", "w", top=1, block_bytes=64).collect()
        assert met[-1].count() == 30 * travels
        assert {r.id: [(m.entry.pos, m.score) for m in r.matches] for r in rows} == expected


def test_estimated_scores_rule_out_no_match():
    """Vectors closer than short floats can tell, equal ones, and ones too large for an estimate."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(7)
    close = 1 + rng.integers(0, 9, (300, 4)) * 1e-5
    signs = rng.integers(-1, 2, (300, 4)) * 1.0
    for known in (close, np.repeat(close[:30], 10, axis=0), close * 3e9, close * 1e20, signs):
        asked = np.concatenate((close[:20], rng.integers(-1, 2, (20, 4))))
        names = rng.permutation(300)
        left = pa.table({"key": list(range(40)), "vector": asked.tolist()})
        term = pa.struct([("term", pa.string()), ("points", pa.float64())])
        left = left.append_column("terms", pa.nulls(40, pa.list_(term)))
        right = pa.table({"position": names, "vector": known.tolist(), "term": pa.nulls(300, pa.string())})
        for top, block_bytes in ((1, 1 << 24), (3, 1 << 24), (3, 200), (400, 1 << 24)):
            got = vectors._scorer(top, block_bytes)(left, right).to_pylist()
            for n, a in enumerate(asked.tolist()):
                # Summed as the scorer does, from the first position on.
                scored = sorted(
                    (-float(np.rint(((a[0] * b[0] + a[1] * b[1]) + a[2] * b[2] + a[3] * b[3]) * 1e4) / 1e4), int(p))
                    for b, p in zip(known.tolist(), names))[:top]
                assert [(-r["score"], r["position"]) for r in got if r["key"] == n] == scored
