"""Derived WARC records: a metadata and a plain-text conversion record per response.

Only DataFrame functions are used. A record's id is made from its type and from the
response it refers to, so a rerun or a retried task makes the same records.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.registry import query

#: Date of derived records where the response has none; a fixed one keeps reruns equal.
EPOCH = "1970-01-01T00:00:00Z"

# Steps from HTML to text, in this order: what matches is replaced.
_HTML_STEPS = [
    (r"(?is)<!--.*?-->", " "),
    (r"(?is)<(?:script|style|noscript|template)\b[^>]*>.*?</(?:script|style|noscript|template)\s*>", " "),
    (r"(?is)</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|title|blockquote|pre)\b[^>]*>",
     "\n"),
    (r"(?s)<[^>]*>", ""),
]
#: A character reference: decimal, hexadecimal or named.
_REFERENCE = "&#?[A-Za-z0-9]{1,31};"
#: Names of characters, as the standard library has them; the no-break space as a blank.
_NAMED = {n: " " if n == "nbsp" else chr(c) for n, c in sorted(name2codepoint.items())} | {"apos": "'"}
_SPACE_STEPS = [(r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", "")]


def _character(piece: Column) -> Column:
    """The character a reference stands for; other text, and unknown names, as they are.
    Numbers of no character give U+FFFD, that of the no-break space a blank."""
    name = F.substr(piece, F.lit(2), F.length(piece) - 2)
    decimal = F.when(name.rlike("^#[0-9]{1,9}$"), F.substr(name, F.lit(2)).try_cast("int"))
    digits = F.when(name.rlike("^#[xX][0-9A-Fa-f]{1,7}$"), F.substr(name, F.lit(3)))
    code = F.coalesce(decimal, F.conv(digits, 16, 10).try_cast("int"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    point = F.when(valid, F.when(code == 0xA0, 0x20).otherwise(code)).otherwise(0xFFFD)
    numbered = F.when(code.isNotNull(), F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    names = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    found = F.coalesce(numbered, F.try_element_at(names, name), piece)
    return F.when(piece.startswith("&") & piece.endswith(";"), found).otherwise(piece)


def html_to_text(html: Column) -> Column:
    """Text of a page: comments, scripts and styles go, blocks become lines."""
    for pattern, instead in _HTML_STEPS:
        html = F.regexp_replace(html, pattern, instead)
    # cut before and behind each reference, so that nothing else changes
    pieces = F.split(html, f"(?={_REFERENCE})|(?<=;)")
    html = F.array_join(F.transform(pieces, _character), "")
    for pattern, instead in _SPACE_STEPS:
        html = F.regexp_replace(html, pattern, instead)
    return html


def _uuid(*parts: Column | str) -> Column:
    """A urn:uuid from a digest of the parts; a null part differs from an empty one."""
    marked = [F.coalesce(F.concat(F.lit("="), p), F.lit("-")) for p in parts]
    h = F.md5(F.concat_ws("\n", *marked))
    cuts = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses_from_pages(pages: DataFrame) -> DataFrame:
    """Response records of a table of pages (page_id, url, html). What such a table lacks,
    as the date and the headers of a response, they lack too."""
    body = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").alias("source_id"),
        _uuid(F.lit("response"), F.col("page_id").cast("string"), F.col("url"), F.col("html")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("http_headers"),
        body.alias("payload"),
    )


def source_records(responses: DataFrame) -> DataFrame:
    """The responses as records of their own, in the columns of ``derive``, so that what
    the derived ones refer to can be written next to them. Without HTTP headers a record is
    a resource, and its block the payload alone."""
    headers = F.coalesce(F.col("http_headers"), F.lit(""))
    payload = F.coalesce(F.col("payload"), F.lit(""))
    block = F.when(headers != "", F.concat(headers, F.lit("\r\n\r\n"), payload)).otherwise(payload)
    rows = responses.select(
        "source_id",
        F.when(headers != "", "response").otherwise("resource").alias("record_type"),
        "record_id",
        F.lit(None).cast("string").alias("refers_to"),
        F.regexp_replace("target_uri", r"[\r\n]+", " ").alias("target_uri"),
        F.coalesce("date", F.lit(EPOCH)).alias("date"),
        F.when(headers != "", "application/http; msgtype=response").otherwise("text/html; charset=utf-8").alias("content_type"),
        F.octet_length(block).cast("long").alias("content_length"),
        _digest(block).alias("block_digest"),
        _digest(payload).alias("source_digest"),
        block.alias("block"),
    )
    return rows.withColumn("record", _record())


def derive(responses: DataFrame) -> DataFrame:
    """Two rows per response: its metadata and its conversion record.

    Columns: source_id, record_type, record_id, refers_to, target_uri, date,
    content_type, content_length (bytes), block_digest, source_digest, block, record
    (the record as it stands in a file). Both derived records keep the response's id as
    WARC-Refers-To; the metadata names the conversion, the source's HTTP headers and
    digests. Null payloads, URIs and headers give empty blocks and no such header line;
    a repeated response gives its records again, with the same ids. No shuffle.
    """
    source = responses.select(
        "source_id",
        "record_id",
        F.regexp_replace("target_uri", r"[\r\n]+", " ").alias("target_uri"),
        F.coalesce("date", F.lit(EPOCH)).alias("date"),
        F.coalesce("http_headers", F.lit("")).alias("http_headers"),
        F.coalesce("payload", F.lit("")).alias("payload"),
    ).select(
        "*",
        _digest(F.col("payload")).alias("source_digest"),
        html_to_text(F.col("payload")).alias("text"),
        _uuid(F.lit("conversion"), F.col("record_id")).alias("conversion_id"),
    )
    length = F.octet_length(F.col("payload")).cast("string")
    fields = F.concat(
        F.lit("source-payload-digest: "), F.col("source_digest"),
        F.lit("\r\nsource-payload-length: "), length,
        F.lit("\r\nconversion-record: "), F.col("conversion_id"),
        F.lit("\r\nconversion-digest: "), _digest(F.col("text")),
        F.when(F.col("http_headers") != "",
               F.concat(F.lit("\r\nsource-http-status: "),
                        F.regexp_replace("http_headers", r"\r\n", "\r\nsource-http-header: "))).otherwise(""),
        F.lit("\r\n"),
    )
    metadata = F.struct(
        F.lit("metadata").alias("record_type"),
        _uuid(F.lit("metadata"), F.col("record_id")).alias("record_id"),
        F.lit("application/warc-fields").alias("content_type"),
        fields.alias("block"),
    )
    conversion = F.struct(
        F.lit("conversion").alias("record_type"),
        F.col("conversion_id").alias("record_id"),
        F.lit("text/plain; charset=utf-8").alias("content_type"),
        F.col("text").alias("block"),
    )
    rows = (
        source.withColumn("derived", F.explode(F.array(metadata, conversion)))
        .select(
            "source_id",
            "derived.record_type",
            "derived.record_id",
            F.col("record_id").alias("refers_to"),
            "target_uri",
            "date",
            "derived.content_type",
            F.octet_length("derived.block").cast("long").alias("content_length"),
            _digest(F.col("derived.block")).alias("block_digest"),
            "source_digest",
            "derived.block",
        )
    )
    return rows.withColumn("record", _record())


def _record() -> Column:
    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit("\r\n\r\n"),
    )


def write_files(records: DataFrame, path: str) -> None:
    """Write the records as gzipped WARC files, one per task, in any file system Spark
    can write to. The writer ends each row with a line feed, the record's last byte."""
    body = F.expr("substring(record, 1, length(record) - 1)")
    records.select(body.alias("record")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _sql() -> str:
    def quoted(s: str) -> str:
        parts = [f"'{p.replace(chr(39), chr(39) * 2)}'" for p in s.split("\n")]
        return " || chr(10) || ".join(parts) if len(parts) > 1 else parts[0]

    text = "payload"
    for pattern, instead in [*_HTML_STEPS]:
        text = f"regexp_replace({text}, '{pattern}', {quoted(instead)}, 'g')"
    names = ", ".join(f"'{n}': chr({ord(c)})" for n, c in _NAMED.items())
    code = """CASE WHEN regexp_full_match(ref, '&#[0-9]{1,9};') THEN try_cast(ref[3:-2] AS BIGINT)
      WHEN regexp_full_match(ref, '&#[xX][0-9A-Fa-f]{1,7};') THEN ('0x' || ref[4:-2])::BIGINT END"""
    character = f"""coalesce(list_transform([{code}], lambda c: CASE WHEN c = 160 THEN ' '
      WHEN c BETWEEN 1 AND 55295 OR c BETWEEN 57344 AND 1114111 THEN chr(c::INT) WHEN c IS NOT NULL THEN chr(65533) END)[1],
      (MAP {{{names}}})[ref[2:-2]], ref)"""
    pieces = f"""string_split_regex(t, '{_REFERENCE}')"""
    text = f"""list_transform([{text}], lambda t: array_to_string(list_transform(list_zip({pieces},
      list_transform(regexp_extract_all(t, '{_REFERENCE}'), lambda ref: {character})), lambda z: z[1] || coalesce(z[2], '')), ''))[1]"""
    for pattern, instead in _SPACE_STEPS:
        text = f"regexp_replace({text}, '{pattern}', {quoted(instead)}, 'g')"

    def urn(h: str) -> str:
        return (f"'<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20]"
                f" || '-' || {h}[21:32] || '>'")

    nl = "chr(13) || chr(10)"
    return f"""
WITH p AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS payload,
  md5('=response' || chr(10) || coalesce('=' || page_id, '-') || chr(10) || coalesce('=' || url, '-') || chr(10)
      || coalesce('=' || html, '-')) AS h FROM pages),
r AS (SELECT *, {urn("h")} AS response_id, 'sha256:' || sha256(payload) AS source_digest, {text} AS text FROM p),
c AS (SELECT *, md5('=conversion' || chr(10) || '=' || response_id) AS ch,
             md5('=metadata' || chr(10) || '=' || response_id) AS mh FROM r),
k AS (SELECT *, {urn("ch")} AS conversion_id, {urn("mh")} AS metadata_id FROM c),
u AS (
  SELECT page_id, 'conversion' AS record_type, conversion_id AS record_id, response_id AS refers_to, target_uri,
         'text/plain; charset=utf-8' AS content_type, source_digest, text AS block FROM k
  UNION ALL
  SELECT page_id, 'metadata', metadata_id, response_id, target_uri, 'application/warc-fields', source_digest,
         'source-payload-digest: ' || source_digest || {nl} || 'source-payload-length: ' || strlen(payload) || {nl}
         || 'conversion-record: ' || conversion_id || {nl} || 'conversion-digest: sha256:' || sha256(text) || {nl} FROM k)
SELECT page_id, record_type, record_id, refers_to, target_uri, '{EPOCH}' AS date, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, source_digest, block,
       'WARC/1.1' || {nl} || 'WARC-Type: ' || record_type || {nl} || 'WARC-Record-ID: ' || record_id || {nl}
       || 'WARC-Refers-To: ' || refers_to || {nl} || coalesce('WARC-Target-URI: ' || target_uri || {nl}, '')
       || 'WARC-Date: {EPOCH}' || {nl} || 'WARC-Block-Digest: sha256:' || sha256(block) || {nl}
       || 'Content-Type: ' || content_type || {nl} || 'Content-Length: ' || strlen(block) || {nl} || {nl}
       || block || {nl} || {nl} AS record
FROM u"""


@query("op10_warc_derivatives", _sql())
def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return derive(responses_from_pages(pages)).withColumnRenamed("source_id", "page_id")
