"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

Every response gives two records. The conversion record holds the page's text; the
metadata record holds the title, counts and the source's HTTP headers, and names the
conversion record. Both refer to the response by WARC-Refers-To and carry the digest
of its payload beside that of their own block. Identifiers are derived from the response's, so
a second run gives the same records.

All of it is DataFrame functions in one narrow pass, without a shuffle. Tags are
removed by patterns, not by a parser: comments, scripts and styles go with what they hold, block
elements end a line, the named character references listed below are resolved.

Defined cases: a null payload counts as empty, a null address as an empty one; repeated
responses give repeated records; a null page id stays null; a page without text gives an empty
conversion record; an empty table gives no rows; other columns of the input do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.secrets import either_case
from tidemart.operators.projections import once

DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
LINE = "\r\n"
_HELD = r"(?:[\x20\x09\x0A\x0D/][^>]*)?>"


def _element(name: str) -> str:
    return rf"(?s)<{either_case(name)}{_HELD}.*?</{either_case(name)}\x20*>"


def _block(names: str) -> str:
    return "</?(?:" + "|".join(either_case(n) for n in names.split()) + ")" + _HELD


BLOCKS = "title p div br h1 h2 h3 h4 h5 h6 li ul ol tr table article section nav header footer blockquote pre body head html"
#: Patterns and their replacements, in order. Each means the same to Java's and to RE2's engine.
STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (_element("script"), ""),
    (_element("style"), ""),
    (_block(BLOCKS), "\n"),
    (r"<[A-Za-z/!?][^>]*>", ""),
    # Character references; the ampersand's comes last.
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
    (r"[\x20\x09\x0B\x0C\x0D]+", " "),
    (r"\x20?\n[\x20\n]*", "\n"),
    (r"^[\x20\n]+", ""),
    (r"[\x20\n]+\z", ""),
)
TITLE = f"<{either_case('title')}{_HELD}([^<]*)<"
LINK = rf"<{either_case('a')}[\x20\x09\x0A\x0D][^>]*{either_case('href')}\x20*="


def plain_text(html: Column) -> Column:
    return reduce(lambda text, step: F.regexp_replace(text, step[0], step[1]), STEPS, html)


def record_id(seed: Column) -> Column:
    """A URN in the form of a UUID, from a digest."""
    h = F.sha2(seed, 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame) -> DataFrame:
    """Responses (page_id, uri, response_id, headers, payload) of raw pages that come without records."""
    uri, payload = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.octet_length(payload).cast("string"), F.lit(LINE),
    )
    seed = F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), uri)
    return pages.select("page_id", uri.alias("uri"), record_id(seed).alias("response_id"), headers.alias("headers"), payload.alias("payload"))


def derivatives(source: DataFrame, date: str = DATE) -> DataFrame:
    """Two records per response: (page_id, warc_type, record_id, refers_to, target_uri, payload_digest,
    block_digest, content_length, header, block)."""
    read = once(source, __text=plain_text(F.col("payload")), __source=digest(F.col("payload")))
    conversion = record_id(F.concat(F.col("response_id"), F.lit(" conversion")))
    metadata = record_id(F.concat(F.col("response_id"), F.lit(" metadata")))
    fields = F.concat(
        F.lit("title: "), F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"[\x20\x09\x0A\x0D]+", " "), F.lit(LINE),
        F.lit("links: "), F.regexp_count("payload", F.lit(LINK)).cast("string"), F.lit(LINE),
        F.lit("text-characters: "), F.length("__text").cast("string"), F.lit(LINE),
        F.lit("conversion-record: "), conversion, F.lit(LINE),
        F.lit("source-payload-digest: "), F.col("__source"), F.lit(LINE),
        F.lit("source-header: "), F.regexp_replace(F.regexp_replace("headers", r"\r\n\z", ""), r"\r\n", "\r\nsource-header: "), F.lit(LINE),
    )

    def record(kind: str, own: Column, media: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("warc_type"), own.alias("record_id"), F.lit(media).alias("media"), block.alias("block"))

    both = F.array(
        record("conversion", conversion, "text/plain; charset=utf-8", F.col("__text")),
        record("metadata", metadata, "application/warc-fields", fields),
    )
    rows = read.select("page_id", "uri", "response_id", "__source", F.inline(both))
    rows = once(rows, block_digest=digest(F.col("block")))
    length = F.octet_length("block").cast("long")
    header = F.concat_ws(
        LINE, F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.col("warc_type")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("response_id")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Refers-To-Payload-Digest: "), F.col("__source")),
        F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest")),
        F.concat(F.lit("Content-Type: "), F.col("media")), F.concat(F.lit("Content-Length: "), length.cast("string")),
        F.lit(""), F.lit(""),
    )
    return rows.select(
        "page_id", "warc_type", "record_id", F.col("response_id").alias("refers_to"), F.col("uri").alias("target_uri"),
        F.col("__source").alias("payload_digest"), "block_digest", length.alias("content_length"),
        header.alias("header"), "block",
    )


def write_files(records: DataFrame, path: str) -> None:
    """Gzipped WARC files: each record's header and block, closed by two line ends (the writer adds the last byte)."""
    text = F.concat("header", "block", F.lit("\r\n\r"))
    records.select(text.alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)
