"""Chat formatting with typed content parts, in column expressions only.

A turn's content is a list of parts. Text parts are escaped and written out, parts of other
kinds become ordered placeholders that name turn and part, and are listed as attachments with
the tokens they will expand to. The escapes are undone exactly by ``unescaped``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.common import blocks, cut, let

PART = "struct<type:string,text:string,ref:string,units:int>"
# Tokens one unit of a part expands to: an image tile, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
TURN_END = "</turn>\n"
PLACEHOLDER = r"^<(.*) ([0-9]+\.[0-9]+)/>$"


def text_part(text: Column) -> Column:
    """A content list with one text part."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def escaped(text: Column) -> Column:
    """No control string of the template can stand in the result, as none does without ``<`` or ``>``."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescaped(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def _tokens(part: Column) -> Column:
    per_unit = F.lit(0)
    for kind, count in TOKENS_PER_UNIT.items():
        per_unit = F.when(part["type"] == kind, count).otherwise(per_unit)
    return (per_unit * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))).cast("long")


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _visited(part: Column, turn: Column, at: Column) -> Column:
    """What a part puts into the text."""
    mark = F.concat(F.lit("<"), escaped(part["type"]), F.lit(" "), turn.cast("string"), F.lit("."),
                    at.cast("string"), F.lit("/>"))
    return F.when(_is_text(part), escaped(part["text"])).otherwise(mark)


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", parts: str = "parts", learned: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv, formatted, spans, attachments, expanded_tokens``.

    ``parts`` is an array of ``PART``. Turns are ordered by ``turn`` (null first), then role and
    content, so ties and repeated rows have one result; a null role or text is empty, a null or
    empty part list an empty turn, a part without a type a text. ``spans`` has for each turn its
    role, where its content stands in ``formatted`` (code points, end exclusive), and whether the
    loss covers it (the role is ``learned``). A null conversation id is a conversation of its own.
    A conversation is one output value, so it has to fit a row; an empty table gives no rows.
    """
    content = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")).cast(f"array<{PART}>")
    grouped = rows.groupBy(F.col(conv).alias("conv")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        content.alias("parts")))).alias("turns"))
    flat = F.transform("turns", lambda t, k: F.struct(
        t["role"].alias("role"),
        F.concat(F.lit("<turn "), escaped(t["role"]), F.lit(">\n")).alias("head"),
        F.array_join(F.transform(t["parts"], lambda p, i: _visited(p, k, i)), "").alias("body"),
        F.transform(
            F.filter(F.transform(t["parts"], lambda p, i: F.struct(p.alias("part"), i.alias("at"))),
                     lambda x: ~_is_text(x["part"])),
            lambda x: F.struct(
                k.cast("long").alias("turn"), x["at"].cast("long").alias("part"),
                x["part"]["type"].alias("type"), x["part"]["ref"].alias("ref"),
                _tokens(x["part"]).alias("tokens"))).alias("attachments")))
    flat = grouped.select("conv", flat.alias("turns"))
    no_spans = F.array().cast("array<struct<role:string,start:long,end:long,loss:boolean>>")
    none = F.struct(F.lit(0).cast("long").alias("at"), no_spans.alias("spans"))

    def placed(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.struct(t["role"].alias("role"), start.alias("start"), end.alias("end"),
                        (t["role"] == learned).alias("loss"))
        return F.struct((end + len(TURN_END)).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    attachments = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    return flat.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))), "")
        .alias("formatted"),
        F.aggregate("turns", none, placed)["spans"].alias("spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"))


def _pieces(body: Column) -> Column:
    """Runs of escaped text and placeholders of a turn, in order: only placeholders have a ``<``."""
    return F.filter(F.regexp_extract_all(body, F.lit(r"<[^<>]*>|[^<>]+"), F.lit(0)), lambda p: p != "")


def _part_back(piece: Column, attachments: Column) -> Column:
    """The part a piece was written from; what a placeholder names is looked up by turn and part."""
    place = F.regexp_extract(piece, PLACEHOLDER, 2)
    own = F.get(F.filter(attachments, lambda a: F.concat_ws(
        ".", a["turn"].cast("string"), a["part"].cast("string")) == place), F.lit(0))
    return F.when(F.startswith(piece, F.lit("<")), F.struct(
        unescaped(F.regexp_extract(piece, PLACEHOLDER, 1)).alias("type"), F.lit(None).cast("string").alias("text"),
        own["ref"].alias("ref"), own["tokens"].alias("tokens"))).otherwise(F.struct(
            F.lit("text").alias("type"), unescaped(piece).alias("text"),
            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens")))


def read_back(formatted: Column, attachments: Column | None = None) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text, parts>>``, escapes undone.

    ``parts`` holds texts and placeholders in order, as ``struct<type, text, ref, tokens>``; text parts
    that stood side by side come back as one, empty ones not at all. ``ref`` and ``tokens`` are those
    of ``attachments``, null without them. ``text`` is what the text parts say, so a text that spells
    a placeholder is never taken for one.
    """
    if attachments is None:
        attachments = F.array().cast("array<struct<turn:long,part:long,type:string,ref:string,tokens:long>>")
    pieces = F.split(formatted, TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = r"^<turn ([^>]*)>\n"

    def turn(piece: Column, k: Column) -> Column:
        mine = F.filter(attachments, lambda a: a["turn"] == k)
        body = F.regexp_replace(piece, head, "")
        return F.struct(
            unescaped(F.regexp_extract(piece, head, 1)).alias("role"),
            unescaped(F.regexp_replace(body, r"<[^<>]*>", "")).alias("text"),
            F.transform(_pieces(body), lambda p: _part_back(p, mine)).alias("parts"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, cut from ``formatted`` by the offsets of ``spans``.

    Placeholders under the mask say nothing here; escapes are undone.
    """
    chunks = blocks(formatted)

    def said(s: Column, held: Column) -> Column:
        return unescaped(F.regexp_replace(cut(held, s["start"], s["end"]), r"<[^<>]*>", ""))

    return let(chunks, lambda held: F.array_join(F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: said(s, held)), ""))
