"""Personal data and what gives it away, in DataFrame operations only.

Patterns find the protected entities. A term of their texts discloses an entity when two things
hold, by counts over the distinct texts of the corpus. It stands with the entity again and again, more
often than texts of that length explain: that one text holds both says nothing, each further one
counts, and all terms of the entity's texts together may yield ``FALSE_FINDINGS`` by chance. And its
pointwise mutual information with the entity, less the bits it takes to tell it from the terms
that say as much, reaches a share of the entity's own information content. Such terms are
generalised wherever they stand, in all texts, and removed when they say as much as the entity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchtide.llm.bitmap import bitmap_of, bits_for, may_hold
from merchtide.llm.common import blocks, boxed, cut, let, prepared
from merchtide.sources.storage import stage

# What the kinds look like, in the order of the result. A match may only start
# where a run starts or the last match ended, and gives nothing back: the same matches in time
# that is linear in the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without the first of these has no match of the kind.
NEEDS = {"email": "@", "phone": "+", "ip": "."}
SPAN = "struct<kind:string,start:long,end:long>"
# Words of letters as group 1; what could be an address is passed over as a whole.
TERM = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]*+"
        r"|(?<![\p{L}\p{N}@._%+-])(\p{L}{2,}+)(?![\p{N}_%+-])")
# Terms that chance alone may give away an entity, over all terms of its texts.
FALSE_FINDINGS = 0.01
# Share of the entity's information from which a term is generalised, and removed.
GENERALISE_AT, REMOVE_AT = 0.8, 0.99
# Values added up at once, so that long texts take linear time.
CHUNK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum of card numbers: every second digit from the right counts twice."""
    each = F.split(F.reverse(digits), "")
    each = F.transform(each, lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    total = F.aggregate(each, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.try_to_number(p, F.lit("999")) <= 255))
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _before(values: Column, merge) -> Column:
    """For each value, all values before it merged, from 0; one more entry for all of them.

    In two levels, as an array that grows value by value would be copied for each.
    """
    zero = F.lit(0).cast("long")

    def grown(start: Column, rows: Column) -> Column:
        return F.aggregate(rows, F.array(start), lambda s, v: F.concat(s, F.array(merge(F.element_at(s, -1), v))))

    def joined(chunks: Column, starts: Column) -> Column:
        each = F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), lambda c, s: F.slice(grown(s, c), 1, F.size(c)))
        return F.concat(F.flatten(each), F.array(F.element_at(starts, -1)))

    def by_chunk(v: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(1), F.size(v), F.lit(CHUNK)), lambda i: F.slice(v, i, CHUNK))
        tops = lambda c: F.transform(c, lambda x: F.aggregate(x, zero, merge))
        return F.when(F.size(v) > 0, let(chunks, lambda c: let(
            grown(zero, tops(c)), lambda starts: joined(c, starts)))).otherwise(F.array(zero))

    return let(values, by_chunk)


def _laid_out(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<match, start, end>>`` (code points) of all matches; ``match`` is their ``group``."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<match:string,start:long,end:long>>")

    def placed(found: Column) -> Column:
        # The last gap has no match after it.
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda g: F.length(g).cast("long"))
        matches = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return let(gaps, lambda gap: let(
            F.zip_with(gap, found, lambda g, m: g + F.length(m)),
            lambda step: F.transform(
                F.arrays_zip(matches.alias("match"), gap.alias("gap"), step.alias("step"),
                             F.slice(_before(step, lambda a, b: a + b), 1, F.size(found)).alias("at")),
                lambda r: F.struct(r["match"].alias("match"), (r["at"] + r["gap"]).alias("start"),
                                   (r["at"] + r["step"]).alias("end")))))

    return let(whole, lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def found_spans(text: Column) -> Column:
    """``array<struct<kind, start, end>>`` of a text column, by kind as listed, then start."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")

    def of_kind(kind: str, pattern: str) -> Column:
        spans = F.transform(F.filter(_laid_out(text, pattern), lambda s: _valid(kind, s["match"])), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        if kind in NEEDS:
            spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(none)
        return spans

    return F.concat(*[of_kind(kind, pattern) for kind, pattern in PATTERNS.items()])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _names(spans: Column, text: Column) -> Column:
    """What the spans name, each once."""
    def one(s: Column, blocks: Column) -> Column:
        name = cut(blocks, s["start"], s["end"])
        name = F.when(s["kind"].isin("card", "phone"), _digits(name)).otherwise(F.lower(name))
        return F.struct(s["kind"].alias("kind"), name.alias("name"))
    return let(blocks(text), lambda blocks: F.array_distinct(F.transform(spans, lambda s: one(s, blocks))))


def _terms(text: Column) -> Column:
    """The terms of a whole text, each once."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(1))
    return F.array_distinct(F.transform(F.filter(found, lambda t: t != ""), F.lower))


def protected(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, key, spans, names, terms, size)`` of every row; equal texts have equal keys.

    ``terms`` are those of the whole text, empty where it names nothing; ``size`` its characters.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("body"), found_spans(F.col(f"`{text}`")).alias("spans"))
    some = F.size("spans") > 0
    return rows.select(
        "doc_id", _text_key(F.col("body")).alias("key"), "spans",
        F.when(some, _names(F.col("spans"), F.col("body"))).otherwise(
            F.array().cast("array<struct<kind:string,name:string>>")).alias("names"),
        F.when(some, _terms(F.col("body"))).otherwise(F.array().cast("array<string>")).alias("terms"),
        F.length("body").cast("long").alias("size"))


def _filter_of(rows: DataFrame, column: str, label: str):
    """A bitmap, a test that is true for the values of ``column`` and few others, and the rows' number.

    ``rows`` are a staged table. The bitmap is sized by them and bounded (``bits_for``). It is a
    subquery, which lambdas may not hold: add it as a column for these.
    """
    count = rows.count()
    bits = bits_for(count)
    bitmap = stage(bitmap_of(rows.select(F.xxhash64(column).alias("hash")), bits), label).select("bitmap").scalar()
    return bitmap, (lambda value, held=bitmap: may_hold(held, F.xxhash64(value), bits)), count


def _each_once(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``(key, body)`` of every distinct text. Only texts that may have copies are shuffled."""
    copied = stage(found.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key"), "copied")
    _, maybe, _ = _filter_of(copied, "key", "copied-filter")
    body = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("body"))
    rows = body.select(_text_key(F.col("body")).alias("key"), "body").withColumn("copied", maybe(F.col("key")))
    again = rows.where("copied").groupBy("key").agg(F.max("body").alias("body"))
    return rows.where(~F.col("copied")).select("key", "body").union(again)


def _ways(n: Column, k: Column) -> Column:
    """An upper bound of the bits in ``n`` choose ``k``."""
    few = F.least(k, n - k)
    return F.when(few > 0, few * F.log2(F.lit(math.e) * n / few)).otherwise(0.0)


def telling_terms(
    found: DataFrame, docs: DataFrame, text: str = "text", generalise_at: float = GENERALISE_AT,
    false_findings: float = FALSE_FINDINGS,
) -> DataFrame:
    """``(term, ratio)`` of the terms that give an entity away, by the entity they say most of.

    Counts are exact and of distinct whole texts over the whole corpus, so copies prove nothing. Of
    an entity in one text only there is nothing to learn.
    """
    own = stage(found.where(F.size("spans") > 0).groupBy("key").agg(
        F.first("names").alias("names"), F.first("terms").alias("terms"), F.first("size").alias("size")), "own")
    corpus = found.groupBy("key").agg(F.first("size").alias("size")).agg(
        F.count("*").alias("n"), F.avg("size").alias("mean"))
    mention = own.select("key", "size", F.size("terms").alias("tested"), F.explode("names").alias("e"))
    entity = mention.groupBy("e").agg(
        F.count("*").alias("n_entity"), F.sum("tested").alias("tested"), F.avg("size").alias("size"),
        F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
    # Entities that stand in the same texts have the same counts with every term: one stands for all.
    alike = entity.where(F.col("n_entity") > 1).groupBy("n_entity", "tested", "size", "x", "y").agg(F.min("e").alias("e"))
    alike = stage(alike.drop("x", "y"), "entities")
    held = mention.select("key", "e").join(alike.select("e"), "e")
    together = own.select("key", F.explode("terms").alias("term")).join(held, "key").groupBy("e", "term").agg(
        F.count("*").alias("n_both")).where(F.col("n_both") > 1)
    together = stage(together, "together")
    candidates = stage(together.select("term").distinct(), "candidates")
    bitmap, maybe, count = _filter_of(candidates, "term", "candidates-filter")
    if count == 0:
        return candidates.select("term", F.lit(0.0).alias("ratio"))
    counted = _each_once(found, docs, text).withColumn("held", bitmap).select(F.explode(F.filter(
        _terms(F.col("body")), lambda t: maybe(t, F.col("held")))).alias("term"))
    counted = counted.groupBy("term").agg(F.count("*").alias("n_term"))
    # One row, so the cross join adds two columns.
    rows = together.join(counted, "term").join(alike, "e").crossJoin(F.broadcast(corpus))
    n, n_entity, n_term, n_both = (F.col(c).cast("double") for c in ("n", "n_entity", "n_term", "n_both"))
    chance = F.least(n_term / n * F.col("size") / F.col("mean"), F.lit(1.0))
    evidence = -(n_both - 1) * F.log2(chance) - _ways(n_entity - 1, n_both - 1)
    shared = F.log2(n * n_both / (n_term * n_entity))
    whole = F.log2(n / n_entity)
    rows = rows.where((whole > 0) & (evidence >= F.log2(F.col("tested") / false_findings))).select(
        "e", "term", (shared / whole).alias("share"), whole.alias("whole")).where(F.col("share") >= generalise_at)
    rows = stage(rows.withColumn("step", F.floor(F.col("share") * 100)), "shares")
    # Terms that say as much, to a percent, or more.
    better = Window.partitionBy("e").orderBy(F.desc("step"))
    rivals = rows.groupBy("e", "step").agg(F.count("*").alias("n")).select(
        "e", "step", F.sum("n").over(better).alias("rivals"))
    ratio = F.col("share") - F.log2("rivals") / F.col("whole")
    return rows.join(rivals, ["e", "step"]).select("term", ratio.alias("ratio")).where(
        F.col("ratio") >= generalise_at).groupBy("term").agg(F.max("ratio").alias("ratio"))


def disclosing_terms(found: DataFrame, docs: DataFrame, text: str = "text",
                     generalise_at: float = GENERALISE_AT) -> DataFrame:
    """``(key, terms)``: where in which texts, with an entity or without, a telling term stands."""
    telling = stage(telling_terms(found, docs, text, generalise_at), "telling")
    bitmap, maybe, count = _filter_of(telling, "term", "telling-filter")
    body = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("body"))
    kind = "array<struct<start:long,end:long,ratio:double>>"
    if count == 0:
        return body.limit(0).select(_text_key(F.col("body")).alias("key"), F.array().cast(kind).alias("terms"))
    # Each text names a term once, however often it holds it; its places are found beside the text.
    hits = body.withColumn("held", bitmap).select(_text_key(F.col("body")).alias("key"), F.explode(F.filter(
        _terms(F.col("body")), lambda t: maybe(t, F.col("held")))).alias("term")).join(telling, "term")
    hits = stage(hits.groupBy("key").agg(F.collect_set(F.struct("term", "ratio")).alias("hits")), "hits")
    _, touched, _ = _filter_of(hits, "key", "hits-filter")
    bodies = body.select(_text_key(F.col("body")).alias("key"), "body").where(touched(F.col("key")))
    rows = bodies.groupBy("key").agg(F.max("body").alias("body")).join(hits, "key")
    places = let(F.map_from_entries("hits"), lambda ratio: F.transform(_laid_out(F.col("body"), TERM, 1), lambda p: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), F.try_element_at(ratio, F.lower(p["match"])).alias("ratio"))))
    return rows.select("key", F.filter(places, lambda p: p["ratio"].isNotNull()).alias("terms"))


def all_spans(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``(key, spans, terms)`` of every text that has any: its spans and the terms added to them."""
    terms = disclosing_terms(found, docs, text)
    own = found.where(F.size("spans") > 0).select("key", "spans").distinct()
    none = F.array().cast("array<struct<start:long,end:long,ratio:double>>")
    joined = own.join(terms, "key", "full").select(
        "key", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"), F.coalesce("terms", none).alias("terms"))
    # A term that touches an entity is gone with it.
    return joined.withColumn("terms", F.filter("terms", lambda t: ~F.exists(
        "spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))))


def inspect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans, terms)`` of every row: entity spans, and disclosing terms with their ratio.

    A null text counts as empty and has neither. Repeated rows stay; equal texts have equal
    results; empty tables give no rows.
    """
    prepared(docs.sparkSession)
    found = stage(protected(docs, doc_id, text), "protected")
    added = stage(all_spans(found, docs, text), "spans").where(F.size("terms") > 0).select("key", "terms")
    none = F.array().cast("array<struct<start:long,end:long,ratio:double>>")
    return found.select("doc_id", "key", "spans").join(added, "key", "left").select(
        "doc_id", "spans", F.coalesce("terms", none).alias("terms"))


def rewritten(text: Column, spans: Column, terms: Column, remove_at: float = REMOVE_AT) -> Column:
    """The text with entities and terms replaced by their kind, and the most telling terms removed.

    Overlapping spans go as one, marked as what starts first, of these the longest.
    """
    marks = F.sort_array(F.concat(
        F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("less"),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark"))),
        F.transform(terms, lambda t: F.struct(
            t["start"].alias("start"), (-t["end"]).alias("less"),
            F.when(t["ratio"] >= remove_at, "").otherwise("[TERM]").alias("mark")))))

    def joined(marks: Column, done: Column, blocks: Column) -> Column:
        pieces = F.zip_with(marks, F.slice(done, 1, F.size(marks)), lambda m, at: F.when(
            m["start"] >= at, F.concat(cut(blocks, at, m["start"]), m["mark"])).otherwise(""))
        rest = cut(blocks, F.element_at(done, -1), F.length(text).cast("long"))
        return F.concat(F.array_join(pieces, ""), rest)

    def ends(marks: Column) -> Column:
        return _before(F.transform(marks, lambda m: -m["less"]), lambda a, b: F.greatest(a, b))

    return let(marks, lambda m: let(ends(m), lambda done: let(blocks(text), lambda b: joined(m, done, b))))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten, and the column ``length``, if named, set to its new length.

    Null texts stay null; a text without personal data or telling terms stays as it is, byte for byte.
    Repeated rows stay, equal texts change alike, and empty tables give no rows. Work is linear in a text.
    """
    prepared(docs.sparkSession)
    found = stage(protected(docs, doc_id, text), "protected")
    spans = stage(all_spans(found, docs, text), "spans").withColumnRenamed("key", "span_key")
    _, touched, _ = _filter_of(spans, "span_key", "span-filter")
    own = F.col("row")[text]
    # Texts that stay as they are go without a join.
    rows = docs.select(boxed(docs)).withColumn("text_key", _text_key(own)).withColumn(
        "touched", touched(F.col("text_key")))
    joined = rows.where("touched").join(spans, F.col("text_key") == F.col("span_key"), "left")
    joined = joined.withColumn("new_text", F.when(F.col("span_key").isNull(), own).otherwise(
        rewritten(own, F.col("spans"), F.col("terms")))).select("row", "new_text")
    joined = joined.union(rows.where(~F.col("touched")).select("row", own.alias("new_text")))
    columns = []
    for name, kind in docs.dtypes:
        if name == text:
            columns.append(F.col("new_text").alias(name))
        elif name == length:
            columns.append(F.length("new_text").cast(kind).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return joined.select(*columns)
