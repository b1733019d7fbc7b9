"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A derived record refers to its response (``WARC-Refers-To``, and its target and date), carries the response's
HTTP headers and payload digest on, and has an id and block digest of its own, both derived from the content, so a
task that runs again writes the same records. A page is read once, in an Arrow batch; all else is a column expression.
"""

from __future__ import annotations

import html.entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from colonnade.llm.base import query

#: The records' date where a table has none.
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"

#: What is no content, tags that end a line, other tags, the title, and the target of a link in its three forms.
HIDDEN = r"(?is)<!--.*?-->|<(?:script|style|noscript|template)\b.*?(?:</(?:script|style|noscript|template)\s*>|\z)"
BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
TAG = r"<[!/?a-zA-Z][^>]*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"
HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: A character reference: a number, or a name with its semicolon or an old name without.
REFERENCE = r"&(?:#[xX][0-9a-fA-F]{1,8}|#[0-9]{1,9}|[A-Za-z][A-Za-z0-9]*);?"
BLANKS, BREAK = r"[ \t\r\f\x{a0}]+", r" ?\n[ \n]*"

_HIDDEN, _BLOCK, _TAG, _TITLE, _HREF, _REFERENCE = (re.compile(x.replace(r"\z", r"\Z")) for x in (HIDDEN, BLOCK, TAG, TITLE, HREF, REFERENCE))
_BLANKS, _BREAK = re.compile("[ \t\r\f\xa0]{2,}|[\t\r\f\xa0]"), re.compile(BREAK)
#: Numbers under 160 follow the rules for old code pages, which the standard library has.
_LOW = [html.unescape(f"&#{n};") for n in range(160)]
_NAMES = html.entities.html5


def _character(m: re.Match) -> str:
    ref = m.group()[1:]
    if ref[0] != "#":
        return _NAMES.get(ref, m.group())
    digits = ref[1:].rstrip(";")
    n = int(digits[1:], 16) if digits[0] in "xX" else int(digits)
    if n < 160:
        return _LOW[n]
    return "\ufffd" if n > 0x10FFFF or 0xD800 <= n < 0xE000 else chr(n)


def unescape(text: str) -> str:
    """A text with its character references replaced, each once; what names no character stays."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _lines(markup: str) -> str:
    text = unescape(_TAG.sub("", _BLOCK.sub("\n", markup)))
    return _BREAK.sub("\n", _BLANKS.sub(" ", text)).strip(" \n")


def read_page(page: str) -> tuple[str, str, list[str]]:
    """Text (blocks on lines of their own), title and the different link targets of a page, in order; an unclosed script runs to the end."""
    shown = _HIDDEN.sub(" ", page)
    title = _TITLE.search(shown)
    links = dict.fromkeys(unescape(a or b or c) for a, b, c in _HREF.findall(shown))
    return _lines(shown), _lines(title.group(1)).replace("\n", " ") if title else "", list(links)


@F.arrow_udf(StructType([StructField("text", StringType()), StructField("title", StringType()), StructField("links", ArrayType(StringType()))]))
def page_parts(pages: pa.Array) -> pa.Array:
    parts = [read_page(x.as_py() or "") for x in pages]
    text, title, links = zip(*parts) if parts else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array(title, pa.string()), pa.array(links, pa.list_(pa.string()))], ["text", "title", "links"])


def digest(content: Column) -> Column:
    """``sha1:`` and the base32 form of a string's SHA-1."""
    h = F.sha1(F.encode(content, "UTF-8"))
    groups = [F.conv(F.substring(h, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    chars = [F.substring(F.lit(BASE32), F.shiftright(g, s).bitwiseAND(31) + 1, F.lit(1)) for g in groups for s in (15, 10, 5, 0)]
    return F.concat(F.lit("sha1:"), *chars)


def record_id(*parts: Column) -> Column:
    """A name-based ``urn:uuid`` of the parts."""
    h = F.md5(F.encode(F.concat_ws("\n", *parts), "UTF-8"))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-3"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """``pages`` (page_id, url, html) as response records; a null page is an empty payload, a null url an empty target."""
    payload, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload), F.lit(CRLF))
    out = pages.select("page_id", url.alias("target_uri"), F.lit(date).alias("date"), head.alias("http_headers"), payload.alias("payload"))
    own = record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "payload")
    return out.withColumns({"record_id": own, "payload_digest": digest(F.col("payload"))})


def derive(records: DataFrame) -> DataFrame:
    """Two rows for each response (page_id, target_uri, date, http_headers, payload, record_id, payload_digest): its metadata
    and its conversion, with ``head`` (the record's named fields), ``block`` and the source's headers and digest.

    Repeated responses give repeated records. A page without title or links has no such field.
    """
    records = records.withColumn("_page", page_parts(F.col("payload")))
    text, title, links = (F.col(f"_page.{c}") for c in ("text", "title", "links"))
    fields = F.concat(
        F.lit("source-digest: "), F.col("payload_digest"), F.lit(CRLF),
        F.array_join(F.transform(F.array_remove(F.split("http_headers", CRLF), ""), lambda x: F.concat(F.lit("source-header: "), x, F.lit(CRLF))), ""),
        F.when(title != "", F.concat(F.lit("title: "), title, F.lit(CRLF))).otherwise(""),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, r"[\r\n]+", " "), F.lit(CRLF))), ""),
    )
    kinds = F.array(F.struct(F.lit("metadata").alias("k"), F.lit("application/warc-fields").alias("ct"), fields.alias("b")), F.struct(F.lit("conversion").alias("k"), F.lit("text/plain; charset=utf-8").alias("ct"), text.alias("b")))
    out = records.select("page_id", "target_uri", "date", "http_headers", "payload_digest", F.col("record_id").alias("refers_to"), F.explode(kinds).alias("d"))
    out = out.select("page_id", F.col("d.k").alias("warc_type"), "refers_to", "target_uri", "date", "http_headers", "payload_digest", F.col("d.ct").alias("content_type"), F.col("d.b").alias("block"))
    out = out.withColumns({"record_id": record_id("warc_type", "refers_to", "block"), "block_digest": digest(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    named = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "date"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    ]
    return out.withColumn("head", F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{n}: "), F.col(c).cast("string"), F.lit(CRLF)) for n, c in named], F.lit(CRLF)))


def record_bytes(derived: DataFrame) -> DataFrame:
    """``record``: each record as it stands in a WARC file, ready to be written part by part."""
    return derived.select(F.encode(F.concat("head", "block", F.lit(CRLF + CRLF)), "UTF-8").alias("record"))


def parse(records: DataFrame) -> DataFrame:
    """The named fields (a map, names in lower case) and the block of ``record`` bytes; the block ends where its length says."""
    text = F.decode("record", "UTF-8")
    cut = F.instr(text, CRLF + CRLF)
    pairs = F.transform(F.slice(F.split(F.substring(text, F.lit(1), cut - 1), CRLF), 2, 1 << 20), lambda x: F.struct(F.lower(F.substring_index(x, ": ", 1)), F.regexp_replace(x, r"\A[^:]*: ", "")))
    fields = F.map_from_entries(pairs)
    body = F.encode(F.substring(text, cut + 4, F.length(text)), "UTF-8")
    return records.select(fields.alias("fields"), F.decode(F.substring(body, F.lit(1), F.get(F.map_values(F.map_filter(fields, lambda k, v: k == "content-length")), F.lit(0)).cast("int")), "UTF-8").alias("block"))


def _quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_unescape(x: str) -> str:
    """Split at ampersands; the start of every later part may be a reference."""
    ref = f"regexp_extract('&' || s, {_quote('^' + REFERENCE)})"
    name = f"coalesce(names[{ref}[2:]], {ref})"
    low = ", ".join(f"chr({ord(c)})" if c else "''" for c in _LOW)
    number = f"(CASE WHEN {ref}[3:3] IN ('x', 'X') THEN ('0x' || rtrim({ref}[4:], ';'))::bigint ELSE rtrim({ref}[3:], ';')::bigint END)"
    known = f"CASE WHEN {number} < 160 THEN [{low}][{number} + 1] WHEN {number} > 1114111 OR {number} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr({number}::int) END"
    one = f"CASE WHEN {ref} = '' THEN '&' || s WHEN {ref}[2:2] = '#' THEN {known} || s[len({ref}):] ELSE {name} || s[len({ref}):] END"
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda s, i: CASE WHEN i = 1 THEN s ELSE {one} END), '')"


def _sql_text(x: str) -> str:
    tags = f"regexp_replace(regexp_replace({x}, {_quote(BLOCK)}, chr(10), 'g'), {_quote(TAG)}, '', 'g')"
    return f"trim(regexp_replace(regexp_replace({_sql_unescape(tags)}, {_quote(BLANKS)}, ' ', 'g'), {_quote(BREAK)}, chr(10), 'g'), ' ' || chr(10))"


def _sql_digest(x: str) -> str:
    parts = [f"substr('{BASE32}', ((('0x' || substr(sha1({x}), {5 * g + 1}, 5))::bigint >> {s}) & 31)::int + 1, 1)" for g in range(8) for s in (15, 10, 5, 0)]
    return "'sha1:' || " + " || ".join(parts)


def _sql_id(x: str) -> str:
    h = f"md5({x})"
    return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'"


_N = "chr(13) || chr(10)"
_NAMES_SQL = "MAP {" + ", ".join(f"{_quote(k)}: " + " || ".join(f"chr({ord(c)})" for c in v) for k, v in _NAMES.items()) + "}"
_LINK = "concat(" + ", ".join(f"regexp_extract(x, {_quote(HREF)}, {g})" for g in (1, 2, 3)) + ")"
SQL = f"""
WITH nm AS MATERIALIZED (SELECT {_NAMES_SQL} AS names),
p AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
r AS (SELECT page_id, target_uri, payload, {_sql_id("concat_ws(chr(10), 'response', coalesce(page_id::varchar, ''), target_uri, payload)")} AS refers_to, {_sql_digest("payload")} AS payload_digest, strlen(payload) AS n FROM p),
w AS (SELECT *, regexp_replace(payload, {_quote(HIDDEN)}, ' ', 'g') AS shown FROM r),
t AS (SELECT w.*, {_sql_text("shown")} AS txt, replace({_sql_text(f"regexp_extract(shown, {_quote(TITLE)}, 1)")}, chr(10), ' ') AS title,
  list_transform(list_transform(regexp_extract_all(shown, {_quote(HREF)}), lambda x: {_LINK}), lambda x: {_sql_unescape("x")}) AS every FROM w, nm),
f AS (SELECT *, 'source-digest: ' || payload_digest || {_N} || 'source-header: HTTP/1.1 200 OK' || {_N} || 'source-header: Content-Type: text/html; charset=utf-8' || {_N} || 'source-header: Content-Length: ' || n || {_N}
  || CASE WHEN title <> '' THEN 'title: ' || title || {_N} ELSE '' END
  || list_aggregate(list_prepend('', list_transform(list_filter(every, lambda x, i: list_position(every, x) = i), lambda x: 'outlink: ' || regexp_replace(x, '[\\r\\n]+', ' ', 'g') || {_N})), 'string_agg', '') AS fields FROM t),
d AS (SELECT page_id, 'metadata' AS warc_type, 'application/warc-fields' AS content_type, refers_to, target_uri, payload_digest, n, fields AS block FROM f
  UNION ALL SELECT page_id, 'conversion', 'text/plain; charset=utf-8', refers_to, target_uri, payload_digest, n, txt FROM f),
e AS (SELECT *, {_sql_id("concat_ws(chr(10), warc_type, refers_to, block)")} AS record_id, {_sql_digest("block")} AS block_digest, strlen(block) AS content_length FROM d)
SELECT page_id, warc_type, record_id, refers_to, target_uri, '{DATE}' AS date, 'HTTP/1.1 200 OK' || {_N} || 'Content-Type: text/html; charset=utf-8' || {_N} || 'Content-Length: ' || n || {_N} AS http_headers, payload_digest, content_type, block_digest, content_length::bigint AS content_length, block,
  'WARC/1.1' || {_N} || 'WARC-Type: ' || warc_type || {_N} || 'WARC-Record-ID: ' || record_id || {_N} || 'WARC-Refers-To: ' || refers_to || {_N} || 'WARC-Refers-To-Target-URI: ' || target_uri || {_N} || 'WARC-Refers-To-Date: {DATE}' || {_N}
  || 'WARC-Target-URI: ' || target_uri || {_N} || 'WARC-Date: {DATE}' || {_N} || 'WARC-Block-Digest: ' || block_digest || {_N} || 'Content-Type: ' || content_type || {_N} || 'Content-Length: ' || content_length || {_N} || {_N} AS head
FROM e"""


@query("op4_warc_derivatives", SQL)
def op4_warc_derivatives(t):
    """Metadata and conversion records of all pages."""
    return derive(responses(t.pages)).select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "http_headers", "payload_digest", "content_type", "block_digest", "content_length", "block", "head"
    )
