"""Derived WARC records: metadata and plain text of archived responses.

Each response gives a conversion record with its text and a metadata record about it. Both
refer to the response by its identifier and repeat what identifies the source: target, date,
payload digest and HTTP headers. Identifiers are digests, so reruns give the same records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchtide.llm.common import prepared

# The date of responses that carry none.
NO_DATE = "1970-01-01T00:00:00Z"
# Elements whose content is not text, elements that end a line, and references. What is
# never closed hides the rest, as in a browser. No tag goes past the next ``<``. So each pattern
# looks at a place a bounded number of times, however a page is made.
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|"
    r"<title\b.*?(?:</title\s*>|\z)")
LINE_END = (
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|"
    r"p|pre|section|table|tr|ul)(?:[\s/][^<>]*)?>")
TAG = r"</?[A-Za-z!][^<>]*>"
REFERENCES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"), ("&middot;", "·"), ("&bull;", "•"), ("&ndash;", "–"),
    ("&mdash;", "—"), ("&hellip;", "…"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"), ("&pound;", "£"), ("&times;", "×"), ("&deg;", "°"),
    ("&amp;", "&"))
TITLE = r"(?is)<title(?:\s[^<>]*)?>(.*?)(?:</title|\z)"
# The target between double quotes, single quotes, or none.
LINK = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*("[^"<>]*"|[\x27][^\x27<>]*[\x27]|[^\s"\x27<>]+)"""


def sha256_digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A URN in the form of a UUID from a digest of the parts."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def with_references(text: Column) -> Column:
    for name, value in REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(value))
    return text


def plain_text(html: Column) -> Column:
    """The visible text, a line per block element, white space collapsed."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, LINE_END, "\n")
    text = with_references(F.regexp_replace(text, TAG, ""))
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as response records: ``page_id, record_id, target_uri, date, http_headers, payload, digests``.

    A null page is an empty payload, a null url an empty target.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    target = F.coalesce(F.col(url), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(
        F.col(page_id).alias("page_id"),
        record_id(F.lit("response"), F.col(page_id), target, F.sha2(payload.cast("binary"), 256)).alias("record_id"),
        target.alias("target_uri"), F.lit(NO_DATE).alias("date"), head.alias("http_headers"),
        payload.alias("payload"), sha256_digest(payload).alias("payload_digest"))


def derived(responses: DataFrame) -> DataFrame:
    """Two rows per response, conversion and metadata, with header fields, block and digest.

    The metadata record names the conversion it goes with. Repeated responses give repeated
    records with the same identifiers. Nothing is shuffled.
    """
    prepared(responses.sparkSession)
    text = responses.withColumn("text", plain_text(F.col("payload"))).withColumn(
        "conversion_id", record_id(F.lit("conversion"), F.col("record_id")))
    title = F.trim(F.regexp_replace(with_references(F.regexp_extract("payload", TITLE, 1)), r"[ \t\r\n]+", " "))
    fields = F.concat(
        F.lit("title: "), title,
        F.lit("\r\nlinks: "), F.size(F.regexp_extract_all("payload", F.lit(LINK), F.lit(1))).cast("string"),
        F.lit("\r\ntext-characters: "), F.length("text").cast("string"),
        F.lit("\r\nconversion: "), F.col("conversion_id"),
        F.lit("\r\nsource-payload-digest: "), F.col("payload_digest"),
        F.lit("\r\nsource-http-headers: "),
        F.replace(F.rtrim(F.col("http_headers"), F.lit("\r\n")), F.lit("\r\n"), F.lit("; ")), F.lit("\r\n"))
    both = F.explode(F.array(
        F.struct(F.lit("conversion").alias("type"), F.col("conversion_id").alias("id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
        F.struct(F.lit("metadata").alias("type"), record_id(F.lit("metadata"), F.col("record_id")).alias("id"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("block"))))
    rows = text.select("page_id", "record_id", "target_uri", "date", "payload_digest", both.alias("r"))
    return rows.select(
        "page_id", F.col("r.type").alias("warc_type"), F.col("r.id").alias("record_id"),
        F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("r.content_type").alias("content_type"),
        F.octet_length("r.block").cast("long").alias("content_length"),
        sha256_digest(F.col("r.block")).alias("block_digest"), F.col("payload_digest").alias("source_digest"),
        F.col("r.block").alias("block"))


def serialised(records: DataFrame) -> DataFrame:
    """Each record as WARC text, but for the two line ends that close it."""
    fields = (
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"), ("Content-Length", "content_length"))
    lines = [F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n")) for name, column in fields]
    return records.select(F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"), F.col("block")).alias("value"))


def write(records: DataFrame, path: str) -> None:
    """Write WARC files, one per partition, compressed as a whole."""
    serialised(records).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
