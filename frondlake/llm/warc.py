"""Derivative WARC records: linked metadata and plain-text conversion records of responses."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: tags that end a line, then all tags; applied before the last '>' only, where every start finds its end
LINE = r"(?i)</?(p|div|br|li|ul|ol|h1|h2|h3|h4|h5|h6|tr|table|article|section|nav|footer|header|main|body|head|html)([ \t\r\n/][^>]*)?>"
TAG = r"(?s)<[a-zA-Z/!?][^>]*>"
#: named character references by rule from the standard table, a hard blank as a plain one
NAMES = {"amp": "&", "apos": "'"} | {n: chr(c) for n, c in name2codepoint.items()} | {"nbsp": " "}
CLOSING_TITLE = r"(?i)</title[ \t\r\n\f]*>"
#: numbers 128 to 159 mean the characters that the Windows code page has there
WINDOWS = {i: c for i in range(128, 160) if (c := bytes([i]).decode("cp1252", "ignore"))}
REFERENCE = r"^(?:([a-zA-Z][a-zA-Z0-9]{1,31})|#([0-9]{1,9})|#[xX]([0-9a-fA-F]{1,7}));"


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _character(code: Column) -> Column:
    """The character of a number; numbers that are none give the replacement character."""
    fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    number = F.unhex(F.lpad(F.hex(F.when(fits, code).otherwise(0xFFFD)), 8, "0"))
    return F.coalesce(F.element_at(_map(WINDOWS), code.cast("int")), F.decode(number, "UTF-32"))


def unescape(c: Column) -> Column:
    """Character references with a closing semicolon decoded, once: names of the standard table and decimal
    and hexadecimal numbers. Unknown names stay as they are. One pass over the pieces between '&'."""

    def piece(p: Column, i: Column) -> Column:
        decimal, hexa = F.regexp_extract(p, REFERENCE, 2), F.regexp_extract(p, REFERENCE, 3)
        code = F.when(decimal != "", decimal.cast("bigint")).when(hexa != "", F.conv(hexa, 16, 10).cast("bigint"))
        number = F.when(F.startswith(p, F.lit("#")), F.when(code.isNotNull(), _character(code)))
        char = F.coalesce(F.element_at(_map(NAMES), F.regexp_extract(p, REFERENCE, 1)), number)
        rest = F.substr(p, F.locate(";", p) + 1)
        return F.when(i == 0, p).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), p)))

    return F.array_join(F.transform(F.split(c, "&", -1), piece), "")


def _without(pages: DataFrame, name: str, opening: str, closing: str) -> DataFrame:
    """``name`` without the stretches from an opening to its next closing; one that never closes goes to the
    end. Linear: each piece between openings is looked through once. ``__pieces`` keeps them."""
    pages = pages.withColumn("__pieces", F.split(name, opening, -1))
    rest = F.transform(F.slice("__pieces", F.lit(2), F.size("__pieces")), lambda p: F.concat(F.lit(" "), F.coalesce(F.get(F.split(p, closing, 2), F.lit(1)), F.lit(""))))
    return pages.withColumn(name, F.concat(F.get("__pieces", F.lit(0)), F.array_join(rest, "")))


def with_markup(pages: DataFrame, html: str) -> DataFrame:
    """Replaces ``html`` by the page without comments, scripts, styles and title, up to the last '>', and
    adds ``__tail``, what lies behind it, and ``__title``, the first title as it stands, if it closes. A
    projection a step, so that nothing is computed twice."""
    pages = _without(pages, html, "<!--", "-->")
    for name in ("script", "style"):
        pages = _without(pages, html, rf"(?i)<{name}(?:>|[ \t\r\n\f/])", rf"(?i)</{name}[ \t\r\n\f]*>")
    pages = _without(pages, html, r"(?i)<title(?:[ \t\r\n\f/][^<>]*)?>", CLOSING_TITLE)
    first = F.split(F.get("__pieces", F.lit(1)), CLOSING_TITLE, 2)
    pages = pages.withColumn("__title", F.coalesce(F.when(F.size(first) == 2, F.get(first, F.lit(0))), F.lit("")))
    pages = pages.withColumn("__tail", F.substring_index(html, ">", -1))
    return pages.withColumn(html, F.substr(html, F.lit(1), F.char_length(html) - F.char_length("__tail"))).drop("__pieces")


def plain_text(head: Column, tail: Column) -> Column:
    """Visible text of ``with_markup``: block tags end lines, other tags vanish, references are decoded, runs
    of blanks become one and empty lines go. Null stays null."""
    text = F.concat(F.regexp_replace(F.regexp_replace(head, LINE, "\n"), TAG, ""), tail)
    text = F.regexp_replace(unescape(text), "[ \t\r]+", " ")
    return F.btrim(F.regexp_replace(text, " ?\n[ \n]*", "\n"), F.lit(" \n"))


def attributes(tags: Column, name: str) -> Column:
    """The decoded values of an attribute in an array of tags, double-quoted, single-quoted or bare; tags
    without it give none."""
    form = rf"""(?i)[ \t\r\n\f]{name}[ \t\r\n\f]*=[ \t\r\n\f]*("[^"]*"|'[^']*'|[^ \t\r\n\f"'>]+)"""
    raw = F.filter(F.transform(tags, lambda t: F.regexp_extract(t, form, 1)), lambda r: r != "")
    return F.transform(raw, lambda r: unescape(F.regexp_replace(r, "^[\"']|[\"']$", "")))


def outlinks(marked: Column) -> Column:
    """Targets of the anchors of ``with_markup`` in order of appearance."""
    return attributes(F.regexp_extract_all(marked, F.lit(r"(?i)<a[ \t\r\n\f/][^>]*>"), F.lit(0)), "href")


def language(marked: Column) -> Column:
    tag = F.regexp_extract(marked, r"(?i)<html[ \t\r\n\f/][^>]*>", 0)
    return F.coalesce(F.get(attributes(F.array(tag), "lang"), F.lit(0)), F.lit(""))


def record_id(kind: str, source: Column) -> Column:
    """A stable URN, so a rebuilt derivative has the identifier of the first one."""
    d = F.md5(F.concat(F.lit(kind + "|"), source).cast("binary"))
    parts = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c.cast("binary"), 256))


def derivatives(responses: DataFrame, source_id: Column, uri: Column, payload: Column, headers: Column, *keep: Column) -> DataFrame:
    """Two records a response, in one pass and without a shuffle. Both refer to the response's
    identifier and URI and carry its headers and payload digest; each names the other in
    ``concurrent_to``. The metadata block holds warc-fields (title, language, source headers,
    outlinks in order of appearance, the conversion's identifier), the conversion block the text.

    A null payload is an empty one, null headers are none, a null identifier or URI stays null and
    the derived identifiers are then made from the payload digest. Repeated responses give repeated
    records; an empty table gives none; long pages are taken whole, by patterns that look at each place
    once. Columns of other names are ignored, whatever they are called. ``keep`` are the caller's columns to carry."""
    body = F.coalesce(payload, F.lit(""))
    base = responses.select(
        *keep, source_id.alias("refers_to"), uri.alias("refers_to_target_uri"), F.coalesce(headers, F.lit("")).alias("source_headers"),
        digest(body).alias("source_payload_digest"), body.alias("body"))
    names = [c for c in base.columns if c != "body"]
    origin = F.coalesce("refers_to", "source_payload_digest")
    base = with_markup(base, "body")
    title = F.btrim(F.regexp_replace(unescape(F.col("__title")), "[ \t\r\n]+", " "))
    # a line end in a value would start a field of its own
    flat = lambda c: F.regexp_replace(c, "[\r\n]+", " ")
    made = base.select(
        *names, record_id("metadata", origin).alias("meta_id"), record_id("conversion", origin).alias("conv_id"),
        F.concat_ws("\r\n", F.concat(F.lit("title: "), title),
                    F.concat(F.lit("language: "), flat(language(F.col("body")))),
                    F.concat(F.lit("conversion: "), record_id("conversion", origin)),
                    F.when(F.col("source_headers") != "", F.concat(F.lit("source-header: "), F.replace("source_headers", F.lit("\r\n"), F.lit("\r\nsource-header: ")))),
                    F.transform(outlinks(F.col("body")), lambda u: F.concat(F.lit("outlink: "), flat(u))), F.lit("")).alias("fields"),
        plain_text(F.col("body"), F.col("__tail")).alias("plain"))

    def record(kind: str, own: str, other: str, mime: str, block: str) -> Column:
        return F.struct(F.lit(kind).alias("record_type"), F.col(own).alias("record_id"), F.col(other).alias("concurrent_to"),
                        F.lit(mime).alias("content_type"), F.octet_length(F.col(block)).cast("long").alias("content_length"),
                        digest(F.col(block)).alias("block_digest"), F.col(block).alias("block"))

    both = F.array(record("metadata", "meta_id", "conv_id", "application/warc-fields", "fields"),
                   record("conversion", "conv_id", "meta_id", "text/plain; charset=utf-8", "plain"))
    return made.select(*names, F.inline(both))


def serialized(records: DataFrame) -> DataFrame:
    """records plus ``warc``: each as one WARC/1.1 record, header, block and closing blank lines."""
    field = lambda name, c: F.concat(F.lit(name + ": "), F.col(c).cast("string"))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), field("WARC-Type", "record_type"), field("WARC-Record-ID", "record_id"),
        field("WARC-Refers-To", "refers_to"), field("WARC-Refers-To-Target-URI", "refers_to_target_uri"),
        field("WARC-Target-URI", "refers_to_target_uri"), field("WARC-Concurrent-To", "concurrent_to"),
        field("WARC-Block-Digest", "block_digest"), field("Content-Type", "content_type"), field("Content-Length", "content_length"))
    return records.withColumn("warc", F.concat(head, F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r\n")).cast("binary"))


def page_responses(pages: DataFrame) -> DataFrame:
    """The pages table as response records: identifier from id, URL and body; the headers a server
    would have sent, as lines."""
    html = F.coalesce("html", F.lit(""))
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), F.md5(html.cast("binary")))
    charset = F.lower(F.regexp_extract(html, r'(?i)<meta [^>]*charset="?([A-Za-z0-9_-]+)', 1))
    mime = F.concat(F.lit("Content-Type: text/html"), F.when(charset != "", F.concat(F.lit("; charset="), charset)).otherwise(F.lit("")))
    return pages.select("page_id", record_id("response", key).alias("response_id"), "url", "html",
                        F.concat_ws("\r\n", mime, F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string"))).alias("headers"))


def page_derivatives(pages: DataFrame) -> DataFrame:
    r = page_responses(pages)
    return derivatives(r, F.col("response_id"), F.col("url"), F.col("html"), F.col("headers"), F.col("page_id"))
