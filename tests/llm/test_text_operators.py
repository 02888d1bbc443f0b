"""The text operators against brute force, and on nulls, empty texts, ties and empty tables."""

import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from merchtide.llm import (
    chat, decontaminate, language, licenses, mixing, neighbours, sanitise, simhash, toxicity, warc)

DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"word{i} alpha beta gamma delta number {i} and more text here", "en", "a") for i in range(8)]
    rows += [(20, "Same text for all of us today", "en", None), (21, "same text for all of us today", "de", "b"),
             (21, "same text for all of us today", "de", "b"), (None, None, None, None), (30, "", "en", "b")]
    return spark.createDataFrame(rows, DOCS)


def test_simhash_components_match_brute_force(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    prints = [int(r.fingerprint, 16) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    for i, r in enumerate(rows):
        ids = [x.doc_id for x, g in zip(rows, group) if g == group[i] and x.doc_id is not None]
        assert r.component_id == min(ids, default=None)


def test_fingerprints_equal_plain_python(spark):
    texts = ["one two", "One TWO three", "a b c d e f g", "a a a a a a", "  É\u00a0x\ty\x0bz  É w ", "", " \n", None,
             "long " * 5000 + "end", "\U0001F600 b c d"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(rows).collect()}
    for i, text in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert found[i] == f"{bits:016x}", text


def test_one_of_each_keeps_one_row(docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()].count(21) == 0


def test_units_cover_the_distance():
    sample = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)
    for total in (1000, 10**9):
        plan = simhash.plan_parts(sample, total)
        assert sum(p.units for p in plan) == simhash.MAX_DISTANCE + 1


def test_decontamination_tolerates_substitutions(spark):
    item = " ".join(f"w{i}" for i in range(20))
    changed = item.replace("w6 ", "x ")
    items = spark.createDataFrame([(1, item), (2, "too short"), (3, None)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"before {item} after"), (2, f"before {changed} after"), (3, "clean text"), (None, None),
         (4, "this is too short indeed")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (4, 2)}
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {3, None}


def test_seeds_see_short_overlaps_with_substitutions(spark):
    for words, changed in ((10, 0), (11, 1), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3), (17, 3), (18, 3), (20, 4)):
        assert decontaminate.missed(decontaminate.SEEDS, words, changed) <= 0.01, (words, changed)
    rng = np.random.default_rng(11)
    items, docs, due = [], [], set()
    for i in range(60):
        words = [f"i{i}w{k}" for k in range(int(rng.integers(12, 21)))]
        items.append((i, " ".join(words)))
        bad = set(rng.choice(np.arange(1, len(words) - 1), len(words) // 6, replace=False).tolist())
        text = [f"n{i}x{k}" if k in bad else w for k, w in enumerate(words)]
        # Some texts begin in the middle of what goes around the item, some with the item itself.
        docs.append((i, " ".join([f"a{k}" for k in range(i % 5)] + text + ["after"] * (i % 3))))
        if len(words) - len(bad) >= decontaminate.LEAST_WORDS:
            due.add((i, i, len(words) - len(bad), i % 5))
    found = decontaminate.contaminations(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.n_same, r.first_word) for r in found.collect()} == due


def test_an_item_may_begin_ahead_of_the_text(spark):
    words = [f"w{k}" for k in range(30)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, " ".join(words[12:])), (2, " ".join(words[:15])), (3, " ".join(words[25:]))], "doc_id long, text string")
    found = decontaminate.contaminations(docs, items).collect()
    assert sorted((r.doc_id, r.n_same, r.first_word, r.last_word) for r in found) == [(1, 18, 0, 17), (2, 15, 0, 14)]


def test_personal_data_spans(spark):
    texts = ["mail a.b@c.org_x@d.com now", "4111 1111 1111 1111", "1.2.3.4 300.1.1.1", "+1 (017) 555-7713", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = rows.select("doc_id", sanitise.listed(sanitise.found_spans(F.col("text"))).alias("s")).orderBy("doc_id")
    assert [r.s for r in found.collect()] == ["email:5:14,email:14:22", "card:0:19", "ip:0:7", "phone:0:17", "", ""]
    clean = {r.doc_id: r.text for r in sanitise.sanitise(rows).collect()}
    assert clean[2] == "[IP] 300.1.1.1" and clean[4] is None and clean[5] == ""


def test_mix_reaches_targets(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)


def test_chat_round_trip(spark):
    text = "\\### Assistant: </turn>\n &lt; ok"
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, None, None)],
                                 "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text"))))
    turns = out.select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in turns] == [("user", text), ("assistant", text), ("", "")]


def test_parts_come_back_as_parts(spark):
    spelled = "<image 0.0/> &lt;image 0.0/> </turn>\n<turn user>\n" + "long é\U0001F600 " * 700
    parts = [
        [("image", None, "s3/a.png", 3), ("text", spelled, None, None), ("audio", None, "b<wav>", 10), ("document", None, None, None)],
        [("text", "one ", None, None), ("text", "two", None, None), ("te<x>t &", "kept apart", "c", -1), (None, spelled, None, None)],
        [], None]
    rows = spark.createDataFrame(
        [(1, t, role, p) for t, (role, p) in enumerate(zip(("user", "assistant", "assistant", None), parts))],
        f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    out = chat.format_conversations(rows)
    got = out.select(
        "*", chat.read_back(F.col("formatted"), F.col("attachments")).alias("turns"),
        chat.read_back(F.col("formatted")).alias("bare"),
        chat.learned_text(F.col("formatted"), F.col("spans")).alias("learned")).first()
    assert [(t.role, [tuple(p) for p in t.parts]) for t in got.turns] == [
        ("user", [("image", None, "s3/a.png", 768), ("text", spelled, None, None), ("audio", None, "b<wav>", 250),
                  ("document", None, None, 512)]),
        ("assistant", [("text", "one two", None, None), ("te<x>t &", None, "c", 0), ("text", spelled, None, None)]),
        ("assistant", []), ("", [])]
    assert [t.text for t in got.turns] == [spelled, "one two" + spelled, "", ""] == [t.text for t in got.bare]
    assert got.learned == "one two" + spelled
    assert got.expanded_tokens == 768 + 250 + 512 and len(got.attachments) == 4
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_license_index_equals_counting():
    index = licenses.build_index({}, licenses.TEMPLATES, licenses.THRESHOLD)
    for text in [*licenses.TEMPLATES.values(), "released under the license", "nothing here"]:
        block = set(licenses.words_of(text))
        share = {n: len(block & set(t)) / len(t) for n, t in index.ordered.items()}
        assert index.matches(block) == {n: s for n, s in share.items() if s >= licenses.THRESHOLD - 1e-9}


def test_nearest_leaves_bad_vectors_out(spark):
    rows = [(i, [1.0, float(i), 0.5]) for i in range(7)] + [(50, None), (51, [0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, vectors.where("vec_id in (0, 50, 51)")).collect()
    assert [(r.rank, r.vec_id) for r in sorted(found, key=lambda r: r.rank)] == [(n, n) for n in range(1, 6)]


def test_models_on_empty_tables(spark, docs):
    none = docs.limit(0)
    model = language.fit(none)
    assert model.predict(["text"]).loc[0, "lang_pred"] == language.UNKNOWN
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels).score(None) == (0.0, [])


def test_warc_links_records(spark):
    pages = spark.createDataFrame([(1, "http://x", "<p>a &amp; b</p><script>x</script>"), (None, None, None)],
                                  "page_id long, url string, html string")
    source = warc.responses(pages)
    ids = {r.record_id for r in source.collect()}
    records = warc.derived(source).collect()
    assert len(records) == 4 and {r.refers_to for r in records} == ids
    assert [r.block for r in records if r.page_id == 1 and r.warc_type == "conversion"] == ["a & b"]
    assert all(re.fullmatch(r"sha256:[0-9a-f]{64}", r.block_digest) for r in records)


def test_pages_made_to_be_slow_take_linear_time(spark):
    n = 60_000
    bodies = ["<a" * n * 8, "<script>" * n, "<!--" * n, "<title>" * n, '<a href="' * n, "<a href='x\" " * n,
              "<a " + "href " * n, "<a href" + " " * n * 4 + "x", "</script " * n, " \n" * n]
    pages = spark.createDataFrame([(i, "u", b) for i, b in enumerate(bodies)], "page_id long, url string, html string")
    start = time.perf_counter()
    assert len(warc.derived(warc.responses(pages)).collect()) == 2 * len(bodies)
    assert time.perf_counter() - start < 30
    assert warc.derived(warc.responses(pages.limit(0))).count() == 0


def test_page_text_and_links(spark):
    html = ("<html><head><title>A &mdash; B</title><style>p{}</style></head><body data-href='no'><p class='x'>One"
            "<br>two &amp;lt;</p><a href=plain>l</a><A class=q HREF = 'single'>m</a><a href=\"double\">n</a>"
            "<a data-href='no'>o</a><header>p</header> 1 < 2<script>never closed <p>gone")
    pages = spark.createDataFrame([(1, "u", html), (1, "u", html)], "page_id long, url string, html string")
    rows = warc.derived(warc.responses(pages)).collect()
    assert len(rows) == 4 and len({r.record_id for r in rows}) == 2
    found = {r.warc_type: r.block for r in rows}
    assert found["conversion"] == "One\ntwo &lt;\nlmno\np\n1 < 2"
    assert "title: A — B\r\n" in found["metadata"] and "links: 3\r\n" in found["metadata"]
    for r, line in zip(rows, warc.serialised(warc.derived(warc.responses(pages))).collect()):
        head, block = line.value.split("\r\n\r\n", 1)
        assert head.startswith("WARC/1.1\r\n") and f"Content-Length: {len(block.encode())}" in head
        assert block == r.block


def test_other_columns_may_have_any_name(spark):
    names = ["row", "id", "print", "number", "hash", "key", "spans", "text_key", "rejected"]
    rows = [(1, "mail a@b.com now", *names), (2, "mail a@b.com now", *names), (3, None, *names), (4, "", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    items = spark.createDataFrame([], "item_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 3]
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns and clean.count() == 4
    safe = sanitise.sanitise(docs).orderBy("doc_id").collect()
    assert [r.text for r in safe] == ["mail [EMAIL] now"] * 2 + [None, ""]
    assert all(tuple(r)[2:] == tuple(names) for r in safe)


def test_neighbours_in_lots_of_queries_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    table = rng.normal(size=(120, 8))
    table[40:60] = table[0]  # one hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(table)]
    vectors = spark.createDataFrame([*rows, rows[7]], "vec_id long, embedding array<double>")
    unit = table / np.linalg.norm(table, axis=1, keepdims=True)
    for query_rows in (7, 1000):
        found = neighbours.nearest(vectors, vectors.where("vec_id % 2 = 0"), tables=30, probes=8, query_rows=query_rows)
        got = {}
        for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
        assert sorted(got) == list(range(0, 120, 2))
        for q, near in got.items():
            score = np.round(unit @ unit[q], 9)
            order = [i for i in np.lexsort((np.arange(120), -score)) if i != q][:5]
            assert near == [(i, score[i]) for i in order]


def test_license_places_are_all_counted():
    index = licenses.build_index({}, licenses.TEMPLATES, licenses.THRESHOLD)
    text = "CC BY by cc by\ncc-by all rights reserved cc cc by " * 50
    words = licenses.words_of(text)
    places = sorted(
        i for p in licenses.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    found = licenses.scan(text, index, licenses.PHRASES)
    assert (found["n_base"], found["first_word"], found["last_word"]) == (len(places), places[0], places[-1])
    empty = licenses.scan(None, index, licenses.PHRASES)
    assert (empty["n_words"], empty["n_base"], empty["first_word"], empty["labels"]) == (0, 0, None, "")


def test_loss_mask_covers_the_learned_texts(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "a < b"), (1, 1, "assistant", "é\U0001F600 & <c>"), (1, 2, "user", ""), (1, 3, "assistant", None)],
        "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text")))).first()
    under = [out.formatted[s.start:s.end] for s in out.spans if s.loss]
    assert under == ["é\U0001F600 &amp; &lt;c&gt;", ""]
    assert [out.formatted[s.start:s.end] for s in out.spans if not s.loss] == ["a &lt; b", ""]


def test_texts_without_letters_have_no_language(spark, docs):
    model = language.fit(docs)
    rows = spark.createDataFrame([(None,), ("",), ("12 !?",), ("alpha beta gamma",)], "text string")
    found = [r.p for r in rows.select(language.predicted(F.col("text"), model).alias("p")).collect()]
    assert [(p.lang_pred, p.score, p.rejected) for p in found[:3]] == [(language.UNKNOWN, 0.0, True)] * 3
    assert found[3].lang_pred in {"en", "de"} and 0 < found[3].score <= 1


def test_pieces_of_a_text_give_the_ngrams_of_the_whole(monkeypatch):
    for text in ("", "a", "ab  c.d! éß " * 50, "  x ", "1 2", "abc" * 30 + "  "):
        whole = language.ngram_counts(text)
        for size in (1, 2, 3, 7):
            with monkeypatch.context() as m:
                m.setattr(language, "CHARACTERS_AT_ONCE", size)
                got = language.ngram_counts(text)
            assert (whole is None and got is None) or np.array_equal(whole, got)


def test_language_of_held_out_rows_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    stems = {"aa": "kala misa tova reni", "bb": "strunk wichtig schlag pfund", "cc": "oiseau beaux jeux yeux"}
    rows = [(i, " ".join(rng.choice(stems[lang].split(), 30)) + f" n{i}", lang) for i, lang in enumerate(list(stems) * 30)]
    rows += [(200, None, "aa"), (201, "12 34", "bb"), (202, "kala misa", None), (203, rows[0][1], "aa")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = frame.where("doc_id % 3 != 0 or doc_id >= 200")
    model = language.fit(learn)
    monkeypatch.setattr(language, "BROADCAST_PICKS", 0)  # the other join gives the same model
    again = language.fit(learn)
    assert np.array_equal(model.centroids, again.centroids) and model.languages == again.languages
    test = frame.where("doc_id % 3 = 0 and doc_id < 200").select("text", "lang", language.predicted(F.col("text"), model).alias("p"))
    for r in test.collect():
        counts = np.log1p(language.ngram_counts(r.text)) * model.weights
        near = model.centroids @ (counts / np.linalg.norm(counts))
        assert r.p.lang_pred == model.languages[int(near.argmax())] == r.lang and not r.p.rejected
        assert abs(r.p.score - near.max()) < 1e-5


def test_toxicity_equals_brute_force_and_knows_held_out_rows(spark):
    rng = np.random.default_rng(6)
    plain = [f"w{k}ord" for k in range(300)]
    bad = ["vilest", "scoundrels", "rotten"]

    def text(toxic):
        lines = [list(rng.choice(plain, 8)) for _ in range(int(rng.integers(1, 9)))]
        if toxic:
            lines[int(rng.integers(len(lines)))].append(str(rng.choice(bad)))
        return ". ".join(" ".join(line) for line in lines) + "."

    rows = [(i, text(i % 8 == 0), int(i % 8 == 0)) for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.where("doc_id < 600").select("doc_id", "text"), frame.select("doc_id", "toxic"))
    found = frame.where("doc_id >= 600").select("text", "toxic", toxicity.scored(F.col("text"), model).alias("t")).collect()
    for r in found:
        clean = 1.0
        for piece in re.split(r"[.!?\n]+", r.text):
            if piece:
                own = {f for w in re.findall(r"\w+", piece.lower()) for f in toxicity.features(w)}
                clean /= 1 + np.exp(model.bias + sum(model.weights.get(f, 0.0) for f in own))
        assert abs(r.t.score - (1 - clean)) < 1e-9
        assert (r.t.score >= toxicity.THRESHOLD) == (r.toxic == 1)
        assert all(any(w in r.text[o.start:o.end] for w in bad) for o in r.t.offending)


def test_toxic_sentence_is_found(spark):
    bad = [(i, f"Nice day number{i}. You vile{i % 3} scoundrel. Bye now.", 1) for i in range(60)]
    good = [(100 + i, f"Nice day number{i}. You kind{i % 3} person. Bye now.", 0) for i in range(60)]
    rows = spark.createDataFrame([*bad, *good, (300, None, 0), (None, "x", 1)], "doc_id long, text string, toxic int")
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    score, found = model.score("Nice day. You vile scoundrel. Bye now.")
    worst = max(found, key=lambda f: f[2])
    assert score > 0.5 and "scoundrel" in "Nice day. You vile scoundrel. Bye now."[worst[0]:worst[1]]
    assert model.score("Nice day. You kind person.")[0] < 0.3 and model.score("") == (0.0, [])


@pytest.fixture(scope="module")
def planted(spark):
    """Texts in which ten surnames stand with one address each, and a hundred words once with one."""
    rng = np.random.default_rng(1)
    words = ["w" + "".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    rare = iter(["r" + "".join(rng.choice(list("klmnopqrst"), 9)) for _ in range(4000)])
    texts = [" ".join([*rng.choice(words, 40), next(rare), next(rare)]) for _ in range(1500)]
    names = {"".join(rng.choice(list("uvxyz"), 9)): k for k in range(10)}
    for name, k in names.items():
        for j in range(4):
            texts[k * 20 + j] += f" {next(rare)} {name.title()} wrote p{k}@x{k}.com {next(rare)}"
        texts[k * 20 + 10] += f" seen {name.upper()}"
    for k in range(100):
        texts[700 + k] += f" {next(rare)} once{k}@y.org {next(rare)}"
    frame = spark.createDataFrame([*enumerate(texts), (5000, texts[10]), (None, None), (5001, "")], "doc_id long, text string")
    return names, texts, words, frame


def test_terms_that_stand_with_an_entity_again_and_again_are_found(planted):
    names, texts, _, docs = planted
    found = sanitise.stage(sanitise.protected(docs), "found")
    telling = {r.term for r in sanitise.telling_terms(found, docs).collect()}
    assert telling == set(names)  # recall 1, precision 1: no word seen once goes
    rows = sanitise.sanitise(docs).collect()
    clean = {r.doc_id: r.text for r in rows}
    assert len(rows) == docs.count() and clean[None] is None and clean[5001] == ""
    assert "[TERM] wrote [EMAIL]" in clean[0] and clean[10].endswith("seen [TERM]") and clean[5000] == clean[10]
    assert clean[300] == texts[300]
    assert clean[700].split() == [w if "@" not in w else "[EMAIL]" for w in texts[700].split()]


def test_long_texts_take_linear_time(spark, planted):
    names, _, words, docs = planted
    rng = np.random.default_rng(2)
    body = [str(w) for w in rng.choice([*words, *names], 100_000)]
    both = docs.union(spark.createDataFrame([(9999, " ".join(body))], docs.schema))
    start = time.perf_counter()
    text = sanitise.sanitise(both).where("doc_id = 9999").first().text
    assert time.perf_counter() - start < 60
    assert text == " ".join("[TERM]" if w in names else w for w in body)


def test_running_values_equal_a_loop(spark):
    values = list(range(1, 1000))
    row = spark.createDataFrame([(values, [])], "v array<long>, e array<long>").select(
        sanitise._before(F.col("v"), lambda a, b: a + b).alias("s"), sanitise._before(F.col("e"), lambda a, b: a + b).alias("e"))
    assert row.first().s == [sum(values[:i]) for i in range(1000)] and row.first().e == [0]


def test_overlap_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    hidden = [True] * 50 + [False, True, True, True] * 60
    masks = [hidden, hidden[::-1], [False] * 9, [True] * 12]
    masks += [(rng.random(rng.integers(1, 70)) < p).tolist() for p in (0.5, 0.7, 0.8, 0.9) for _ in range(15)]
    rows = [(i, [f"w{k}" for k in range(len(m))], ["x", *[f"w{k}" if e else "x" for k, e in enumerate(m)]])
            for i, m in enumerate(masks)]
    frame = spark.createDataFrame(rows, "i long, item_words array<string>, words array<string>")
    found = frame.select("i", decontaminate._overlap(F.lit(1), 0.8).alias("o")).collect()
    assert len(found) == len(masks)
    for r in found:
        mask, o = masks[r.i], r.o
        sums = np.concatenate([[0], np.cumsum(mask)])
        most = max((int(sums[b] - sums[a]) for a in range(len(mask)) for b in range(a + 1, len(mask) + 1)
                    if 5 * (sums[b] - sums[a]) >= 4 * (b - a)), default=0)
        assert o.best_same == most
        if most:
            part = mask[o.best_first:o.best_last + 1]
            assert part[0] and part[-1] and sum(part) == most and 5 * most >= 4 * len(part)


def test_a_thin_stretch_does_not_hide_a_verbatim_one(spark):
    words = [f"w{k}" for k in range(290)]
    text = " ".join(w if k < 50 or (k - 50) % 4 else "x" for k, w in enumerate(words))
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminations(docs, items).collect()] == [1]


def test_wrapped_license_notices_are_found():
    index = licenses.build_index({}, licenses.TEMPLATES, licenses.THRESHOLD)
    for name, template in licenses.TEMPLATES.items():
        own = template.split()
        for width in (1, 2, 5, 9):
            lines = [" ".join(own[i:i + width]) for i in range(0, len(own), width)]
            text = "some code here\n\n# " + "\n# ".join(lines) + "\n\nmore code\n" + "x y z\n" * 50
            found = licenses.scan(text * 2, index, {})
            assert name in found["labels"].split(","), (name, width)
            mine = [b for b in found["blocks"] if b["template"] == name]
            assert len(mine) == 2 and all(b["containment"] >= licenses.THRESHOLD for b in mine)
    whole = licenses.scan("a\n" + licenses.TEMPLATES["isc"] + "\nb", index, {})
    assert [(b["line"], b["first_word"]) for b in whole["blocks"] if b["template"] == "isc"] == [(1, 1)]
    rng = np.random.default_rng(2)
    for name, template in licenses.TEMPLATES.items():
        words = list(rng.choice([*licenses.words_of(template), "x"], 300))
        own, size = set(licenses.words_of(template)), index.length[name]
        brute = any(len(own & set(words[i:i + size])) >= index.need[name] for i in range(len(words)))
        assert brute == (name in {m[0] for m in index.windows(words)})
