"""The operators as queries over the test tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchtide.llm import (
    chat, decontaminate, language, lexical, licenses, mixing, neighbours, packing, sanitise, simhash, spelling,
    toxicity, warc)
from merchtide.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every verified overlap of a document with a benchmark item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    items = table(spark, folder, "benchmark").select("item_id", "text")
    return decontaminate.contaminations(docs, items).drop("digest")


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score, prediction and offending sentences of every document; learned off the held-out rows."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").where(~held_out())
    model = toxicity.fit(docs, labels)
    found = docs.select("doc_id", held_out().alias("held_out"), toxicity.scored(F.col("text"), model).alias("t"))
    return found.select(
        "doc_id", "held_out", "t.score",
        (F.col("t.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("t.offending").cast("long").alias("n_offending"),
        F.get("t.offending", 0)["start"].alias("worst_start"),
        F.get("t.offending", 0)["end"].alias("worst_end"))


@query
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of every fiftieth vector, against all vectors."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query
def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, formatted and read back, and one whose texts hold control strings."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"),
                 F.lit(role).alias("role"), tricky.alias("text"))
        for n, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    turns = rows.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    found = chat.format_conversations(turns)
    return found.select(
        "*", chat.read_back(F.col("formatted"), F.col("attachments")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("spans")).alias("learned")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens")


ORACLES["op4_chat"] = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
    SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS safe,
        replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS safe_role FROM t)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<turn >' || chr(10) || '</turn>' || chr(10)) + length(safe) + length(safe_role)) AS BIGINT)
        AS formatted_chars,
    CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM s GROUP BY conv_id"""


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language and similarity of every document; learned off the held-out rows."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out()))
    found = docs.select("doc_id", held_out().alias("held_out"), language.predicted(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs)


ORACLES["op6_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest FROM documents),
e AS (SELECT *, CAST(floor(size * 1000 / (size + 256)) AS BIGINT) AS liking FROM d),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size * liking) AS BIGINT) AS liked,
        [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight FROM e GROUP BY source),
l AS (
    SELECT *, ((sum(source_size) OVER ()) * 3 / 2 - coalesce(sum(2 * source_size) OVER w, 0))
        / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0)) AS level FROM s
    WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
    SELECT source, source_size, liked,
        least(CAST(2 * source_size AS DOUBLE), (max(level) OVER ()) * weight) AS target FROM l),
j AS (
    SELECT e.*, g.source_size, g.target, coalesce(g.target / nullif(g.source_size, 0), 0) AS mean,
        e.liking / 1000.0::DOUBLE - coalesce(g.liked / nullif(g.source_size, 0), 0) / 1000.0::DOUBLE AS lean
    FROM e JOIN g ON e.source IS NOT DISTINCT FROM g.source),
x AS (SELECT *, mean + least(mean, 2 - mean) * lean AS expected FROM j),
p AS (
    SELECT *, CAST(greatest(floor(expected), 0) AS BIGINT) AS whole,
        greatest(expected - greatest(floor(expected), 0), 0) AS p,
        (CAST('0x' || substr(digest, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM x),
r AS (
    SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / ((1 - u) * p) END AS rnk,
        target - sum(whole * size) OVER (PARTITION BY source) AS room FROM p),
c AS (
    SELECT *, CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN p > 0 AND coalesce(sum(size) OVER (
        PARTITION BY source ORDER BY rnk NULLS LAST, doc_id NULLS FIRST, digest
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 <= room THEN 1 ELSE 0 END END AS n FROM r)
SELECT doc_id, source, size, source_size, target, CAST(n AS BIGINT) AS copies, CAST(n * size AS BIGINT) AS taken
FROM c"""


@query
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Conversion and metadata records of every page."""
    return warc.derived(warc.responses(table(spark, folder, "pages").select("page_id", "url", "html")))


def _sql_text(html: str) -> str:
    text = f"regexp_replace({html}, '{warc.HIDDEN}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{warc.LINE_END}', chr(10), 'g'), '{warc.TAG}', '', 'g')"
    text = f"regexp_replace({_sql_references(text)}, '[ \\t\\r\\f]+', ' ', 'g')"
    return f"trim(regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"


def _sql_references(text: str) -> str:
    for name, value in warc.REFERENCES:
        text = f"replace({text}, '{name}', '{value.replace(chr(39), chr(39) * 2)}')".replace(
            "'&#39;'", "'&#39;'")
    return text


def _sql_id(kind: str, rest: str) -> str:
    h = f"md5('{kind}|' || {rest})"
    cut = " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cut} || '>'"


ORACLES["op7_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
r AS (
    SELECT *, {_sql_id("response", "coalesce(CAST(page_id AS VARCHAR), '') || '|' || target_uri || '|' || sha256(payload)")}
        AS refers_to, {_sql_text("payload")} AS txt,
        trim(regexp_replace({_sql_references(f"regexp_extract(payload, '{warc.TITLE}', 1)")}, '[ \\t\\r\\n]+', ' ', 'g'))
        AS title FROM p),
c AS (
    SELECT *, {_sql_id("conversion", "refers_to")} AS conversion_id, {_sql_id("metadata", "refers_to")} AS metadata_id,
        'sha256:' || sha256(payload) AS source_digest FROM r),
m AS (
    SELECT *, 'title: ' || title || e || 'links: ' || len(regexp_extract_all(payload, '{warc.LINK}', 1)) || e ||
        'text-characters: ' || length(txt) || e || 'conversion: ' || conversion_id || e ||
        'source-payload-digest: ' || source_digest || e ||
        'source-http-headers: HTTP/1.1 200 OK; Content-Type: text/html; charset=utf-8; Content-Length: ' ||
        strlen(payload) || e AS fields FROM c, (SELECT chr(13) || chr(10) AS e)),
u AS (
    SELECT page_id, 'conversion' AS warc_type, conversion_id AS record_id, refers_to, target_uri,
        'text/plain; charset=utf-8' AS content_type, txt AS block, source_digest FROM m
    UNION ALL
    SELECT page_id, 'metadata', metadata_id, refers_to, target_uri, 'application/warc-fields', fields,
        source_digest FROM m)
SELECT page_id, warc_type, record_id, refers_to, target_uri, '{warc.NO_DATE}' AS date, content_type,
    strlen(block) AS content_length, 'sha256:' || sha256(block) AS block_digest, source_digest, block FROM u"""


@query
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates found in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", licenses.scanned(docs).alias("f"))
    return found.select(
        "doc_id", "f.n_words", "f.n_base", "f.first_word", "f.last_word", "f.base_labels", "f.labels", "f.score",
        F.size("f.blocks").cast("long").alias("n_blocks"))


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, and the terms that give it away."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = sanitise.inspect(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in sanitise.PATTERNS]
    terms = F.transform("terms", lambda t: F.struct(
        F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return found.select(
        "doc_id", *counts,
        F.sha2(sanitise.listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        sanitise.listed(F.concat("spans", terms)).alias("spans"))


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    items = table(spark, folder, "benchmark").select("item_id", "text")
    return lexical.search(docs, items)


ORACLES["op11_lexical_search"] = r"""
WITH t AS (
    SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
d AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY row),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
p AS (SELECT row, term, count(*) AS tf FROM t GROUP BY row, term),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
    FROM p, c GROUP BY term, docs),
q AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
m AS (SELECT row, doc_id, 25 + (75 * n * docs) // total AS norm FROM d, c),
s AS (
    SELECT item_id, row, doc_id,
        CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * norm))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (row) GROUP BY item_id, row, doc_id),
r AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank,
        doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""


@query
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 tokens with the mixture of the sources."""
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    pieces = packed.select("sequence_id", "tokens", F.explode("pieces").alias("p"))
    return pieces.select(
        "p.doc_id", "p.start", "p.length", packing.piece_crc(F.col("tokens"), F.col("p")).alias("ids_crc32"),
        "p.doc_tokens", "sequence_id", "p.offset")


@query
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents with its near words, form and root."""
    return spelling.variants(table(spark, folder, "documents").select("doc_id", "text"))
