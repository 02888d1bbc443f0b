"""Lexical search, packing and spelling variants against brute force and on edge cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchtide.llm import lexical, packing, spelling

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
CLASHING = "rank string, score string, item string, place string, queue string, n string, word string, term string"


def random_texts(seed, n, words):
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, rng.integers(0, 40), p=weights / weights.sum())) for _ in range(n)]


# Lexical search

def brute_ranks(docs, items):
    def terms(t):
        found = re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")
        return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]

    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        rows = []
        for d, c, size in held:
            m = 25 + 75 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t])
            if score > 0:
                rows.append((-score, d is not None, d))
        found += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(rows)[:10])]
    return sorted(found, key=repr)


def test_search_equals_brute_force(spark):
    words = ["the", "Of", "été", "x1", "Rare", "zwölf", "a\u4e2d", *[f"w{i}" for i in range(60)]]
    texts = random_texts(1, 400, words)
    docs = [*enumerate(texts), (3, texts[3]), (None, texts[3]), (900, None), (901, ""), (902, "-- !"), (903, "w1 " * 50000)]
    items = [(i, t) for i, t in enumerate(random_texts(2, 30, words))] + [(30, None), (31, "w1 w1 w1"), (31, "w1 w1 w1"), (32, "the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = lexical.search(frame.repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_ranks(docs, items)
    blocks = lexical.search(frame, spark.createDataFrame(items, "item_id long, text string"), block_bytes=200)
    assert sorted(map(tuple, blocks.collect()), key=repr) == brute_ranks(docs, items)


def test_search_stops_before_hopeless_masks():
    texts = [f"common w{i}" for i in range(500)] + ["common needle"] * 20
    block = lexical.Block([(0, "common needle thread")])
    block.learn(520, 1040, {0: 520, 1: 20})
    counts = [Counter(block.numbers[t] for t in lexical.terms_of(x) if t in block.numbers) for x in texts]
    index = lexical.Index(list(range(520)), counts, [2] * 520, block)
    top = []
    assert index.search(block.items[0], top, 10) == 1 and [t[2] for t in top] == list(range(500, 510))


def test_search_on_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0
    wide = docs.selectExpr("*", *[f"'x' as {c.split()[0]}" for c in CLASHING.split(", ")], "'y' as item_id")
    assert [tuple(r)[:3] for r in lexical.search(wide, items.selectExpr("*", "9 as doc_id")).collect()] == [(1, 1, 1)]


# Packing

def unpacked(frame):
    pieces = frame.select("sequence_id", F.length("tokens").alias("bytes"), "tokens", F.explode("pieces").alias("p")).select(
        "sequence_id", "bytes", "p.*", packing.piece_crc(F.col("tokens"), F.col("p")).alias("crc"))
    return pieces.collect()


def check_packing(rows, docs, length):
    """All ids of ``{doc_id: text}`` lie in one piece each, gapless in documents and sequences."""
    plain = tokenizers.Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for d, text in docs.items():
        ids, at = plain.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.crc == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, own in by_sequence.items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].bytes // 4 and (at == length or s == max(by_sequence))
    return by_sequence


def test_packing_fills_every_window_to_the_mixture(spark):
    words = ["hello,", "World", "it's", "Élan", "12", "naïve...", "\u4e2d\u6587", "<|endoftext|>"]
    texts = {i: t for i, t in enumerate(random_texts(3, 600, words))}
    texts.update({700: None, 701: "", 702: "long word " * 5000})
    source = {i: None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 7}" for i in texts}
    docs = spark.createDataFrame([(i, t, source[i]) for i, t in texts.items()], "doc_id long, text string, source string")
    rows = unpacked(packing.pack(docs.repartition(4), PATH, length=256))
    windows = check_packing(rows, texts, 256)
    tokens = Counter()
    for r in rows:
        tokens[source[r.doc_id]] += r.length
    whole = sum(tokens.values())
    for s, own in windows.items():
        if s < max(windows):
            held = Counter()
            for r in own:
                held[source[r.doc_id]] += r.length
            # A token a queue of the round, and the drift of the bounds.
            assert all(abs(held[q] - 256 * tokens[q] / whole) <= len(tokens) + 1 for q in tokens)


def test_packing_with_weights_and_shared_queues(spark):
    texts = {i: "some words here " * (i % 13) for i in range(300)}
    docs = spark.createDataFrame([(i, t, f"s{i % 5}") for i, t in texts.items()], "doc_id long, text string, source string")
    rows = unpacked(packing.pack(docs, PATH, weights={"s0": 3, "s1": 1}, length=128))
    first = [r for r in check_packing(rows, texts, 128)[0]]
    held = Counter()
    for r in first:
        held[f"s{r.doc_id % 5}"] += r.length
    assert abs(held["s0"] - 96) <= 6 and abs(held["s1"] - 32) <= 6
    check_packing(unpacked(packing.pack(docs, PATH, length=128, most_queues=3)), texts, 128)


def test_packing_of_nothing_of_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a b", None, 1), (None, "a b", None, 1), (2**60 + 1, "c", "x", 2)], "doc_id long, text string, source string, queue int")
    assert packing.pack(docs.limit(0), PATH).count() == 0
    rows = unpacked(packing.pack(docs, PATH))
    assert sorted((str(r.doc_id), r.length) for r in rows) == [(str(2**60 + 1), 2), ("None", 3), ("None", 3)]


def test_ids_are_the_tokenizers_own():
    encoder = packing.Encoder(PATH)
    rng = np.random.default_rng(5)
    texts = ["a<|endoftext|>b", "É À Ÿ ß µ ²³¼ x\x85z", "İstanbul ΟΔΟΣ \U0001F600", "I'M don't", "a\x1cb \0d", "e\u0301", ""]
    texts += ["".join(chr(c) for c in rng.choice([32, 39, 44, *range(1, 0x140)], 40)) for _ in range(500)]
    for text in texts * 2:
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == ids


# Spelling

def brute_variants(docs):
    count = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    count = {w: n for w, n in count.items() if n >= 3 and len(w) >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    rows = {}
    for w, n in count.items():
        own = [x for x in count if near(w, x)]
        best = min(own, key=lambda x: (-count[x], x), default=None)
        rows[w] = [n, len(own), best if best and count[best] >= 2 * n else None]
    for w, row in rows.items():
        end = w
        while rows[end][2]:
            end = rows[end][2]
        row += [count[row[2]] if row[2] else None, end]
    return {w: tuple(r) for w, r in rows.items()}


def variants(frame, **options):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(frame, **options).collect()}


def test_variants_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abà"), rng.integers(4, 8))) for _ in range(150)] + ["Éaaaaa", "AAAAAA", "aaaaa", "aaaaaaa"]
    docs = [*enumerate(random_texts(8, 400, words)), (None, "chain chain chain"), (5, None), (6, "")]
    docs += [(7, "x" * 3000 + " " + "x" * 3001 + " " + "x" * 2999 + "y")] * 3
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    expected = brute_variants(docs)
    assert sum(r[2] is not None and r[4] != r[2] for r in expected.values()) > 1
    assert variants(frame) == expected
    assert variants(frame, lot_words=10) == expected


def test_tries_give_a_number_per_prefix():
    words = sorted({"a", "ab", "abc", "abd", "b", "ba", "bab", "babc", "bb", "c"})
    for size in (1, 2, 3, 4, 20):
        lots = [words[i:i + size] for i in range(0, len(words), size)]
        shared = spelling.shared_paths([(n, lot[0], lot[-1]) for n, lot in enumerate(lots)])
        number = {}
        for n, lot in enumerate(lots):
            for word, path in zip(lot, spelling.node_paths(lot, *shared[n], (n + 1) << 20)):
                assert len(path) == len(word) + 1
                for depth, node in enumerate(path):
                    assert number.setdefault(word[:depth], node) == node
        assert len(set(number.values())) == len(number)


def test_variants_of_nothing_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "hello hello hello hellos")], "doc_id long, text string")
    assert variants(docs.limit(0)) == {}
    wide = docs.selectExpr("*", *[f"'x' as {c.split()[0]}" for c in CLASHING.split(", ")])
    assert variants(wide) == brute_variants([(1, "hello hello hello hellos")])


def test_words_are_cut_once_a_process():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.encoder_of(path, True) is packing.encoder_of(path, True)
    asked = []
    words = packing.Words(lambda word: asked.append(word) or word.encode())
    assert [words[w] for w in ("a", "b", "a")] == [b"a", b"b", b"a"] and asked == ["a", "b"]
