"""WARC derivatives: a metadata and a conversion record for each response.

Everything is made of the response's row (character references are resolved in
Arrow batches), so records are built where the response is read and nothing is shuffled.  Both derivatives refer to the
response, keep its target, date, source headers and payload digest, and carry
digests of their own blocks.  Record ids follow from the response's id and the
record's type, so a task that runs again writes the same records.
"""

from __future__ import annotations

import html as html_rules
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm.session import prepare

CRLF = "\r\n"
RESPONSE = "record_id string, target_uri string, warc_date string, http_headers string, payload string"

# What of HTML is no text, what parts lines; LINK is that of the SQL twin, which reads double quotes only.
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>"
BREAKS = r"(?i)<(?:/?(?:p|div|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|blockquote|pre)\b[^>]*|br\b[^>]*)>"
TAGS = r"<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LINK = r'(?i)<a\b[^>]*?\bhref="([^"]*)"'
#: An anchor's first href in double quotes, in single quotes or bare; quoted values of other attributes are passed over whole.
ANCHOR = r"""(?is)<a(?=[\s/])(?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|=(?!\s*["'])|["'](?=[\s/>]))*?[\s/"']href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns text, title and links with all character references of HTML resolved."""
    decoded = lambda x: html_rules.unescape(x).replace("\xa0", " ")
    for batch in batches:
        columns = []
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if name in ("text", "title"):
                column = pa.array([x if x is None or "&" not in x and "\xa0" not in x else decoded(x) for x in column.to_pylist()], pa.string())
            elif name == "links":
                column = pa.array([[html_rules.unescape(x) for x in links] for links in column.to_pylist()], pa.list_(pa.string()))
            columns.append(column)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _shown(html: Column) -> Column:
    """Text with its references: scripts, styles, the head, comments and tags go, blocks end lines."""
    text = F.regexp_replace(html, UNSEEN, "")
    text = F.regexp_replace(text, BREAKS, "\n")
    return F.regexp_replace(text, TAGS, "")


def _lines(text: Column) -> Column:
    """Blank lines and outer spaces go."""
    text = F.regexp_replace(text, r"[ \t\r]*\n[ \t\r\n]*", "\n")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def record_uuid(seed: Column) -> Column:
    """A urn:uuid that follows from the seed."""
    h = F.md5(seed)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def responses_from_pages(pages: DataFrame) -> DataFrame:
    """Response rows for a table of ``page_id``, ``url`` and ``html``.

    The table has no crawl times; the date is the start of 2024 plus page_id
    seconds, for reproducible records.  A null url or html stays null.
    """
    when = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.col("page_id"), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return pages.select(
        "page_id",
        record_uuid(F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))).alias("record_id"),
        F.col("url").alias("target_uri"),
        when.alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "), F.octet_length(F.coalesce("html", F.lit(""))).cast("string")).alias("http_headers"),
        F.col("html").alias("payload"),
    )


def _headers(kind: str, content_type: str, block: Column) -> Column:
    return F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), record_uuid(F.concat_ws("|", F.lit(kind), "record_id"))),
        F.concat(F.lit("WARC-Refers-To: "), F.col("record_id")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")),
        F.concat(F.lit("WARC-Date: "), F.col("warc_date")),
        F.concat(F.lit("WARC-Block-Digest: "), _digest(block)),
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )


def _record(kind: str, content_type: str, block: str) -> Column:
    body = F.col(block)
    return F.struct(
        F.lit(kind).alias("warc_type"),
        record_uuid(F.concat_ws("|", F.lit(kind), "record_id")).alias("record_id"),
        F.col("record_id").alias("refers_to"),
        F.col("target_uri"),
        F.col("warc_date"),
        F.lit(content_type).alias("content_type"),
        F.octet_length(body).cast("bigint").alias("content_length"),
        _digest(body).alias("block_digest"),
        F.col("source_digest"),
        F.col("http_headers").alias("source_headers"),
        _headers(kind, content_type, body).alias("headers"),
        body.alias("block"),
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records per response: ``metadata`` and ``conversion``, with all that the response's table also has of ``page_id``.

    A null payload counts as empty, with empty text and no links; a null
    target, date or header is left out of the WARC header.  Repeated rows give
    repeated records; other columns are not read; an empty table gives no rows.
    """
    prepare(responses.sparkSession)
    keep = [c for c in ("page_id",) if c in responses.columns]
    html = F.coalesce(F.col("payload").cast("string"), F.lit(""))
    read = responses.select(*keep, "record_id", "target_uri", "warc_date", "http_headers", html.alias("html"), _digest(html).alias("source_digest"))
    quoted = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1))
    fields = read.select(
        *keep, "record_id", "target_uri", "warc_date", "http_headers", "source_digest",
        _shown(F.col("html")).alias("text"),
        F.regexp_extract("html", TITLE, 1).alias("title"),
        F.transform(quoted, lambda x: F.when(x.rlike("^[\"']"), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x)).alias("links"),
    )
    fields = fields.mapInArrow(_decode, fields.schema).withColumn("text", _lines(F.col("text"))).withColumn("title", F.trim("title"))
    metadata = F.concat(
        F.concat(F.lit("title: "), F.regexp_replace("title", r"\s+", " "), F.lit(CRLF)),
        F.concat(F.lit("source-payload-digest: "), F.col("source_digest"), F.lit(CRLF)),
        F.coalesce(F.concat(F.lit("source-"), F.replace("http_headers", F.lit(CRLF), F.lit(CRLF + "source-")), F.lit(CRLF)), F.lit("")),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(F.trim(x), r"[\r\n\t]", ""), F.lit(CRLF))), ""),
    )
    blocks = fields.select(*keep, "record_id", "target_uri", "warc_date", "http_headers", "source_digest", "text", metadata.alias("metadata"))
    both = F.array(_record("metadata", "application/warc-fields", "metadata"), _record("conversion", "text/plain; charset=utf-8", "text"))
    return blocks.select(*keep, F.inline(both))


def records(derived: DataFrame) -> DataFrame:
    """The derived rows' records as text: header, blank line, block and two line ends."""
    return derived.withColumn("record", F.concat("headers", F.lit(CRLF * 2), "block", F.lit(CRLF * 2)))


def _resolved_sql(text: str) -> str:
    """DuckDB's expression for ``text`` with every reference that ends in a semicolon resolved, by name from ``names`` or by number."""
    pieces = f"regexp_extract_all({text}, '&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&')"
    number = "chr(CAST(substr(p, 3, length(p) - 3) AS INTEGER))"
    hexadecimal = "chr(CAST(concat('0x', substr(p, 4, length(p) - 4)) AS INTEGER))"
    one = f"CASE WHEN p[2] <> '#' OR length(p) < 4 OR p[1] <> '&' THEN coalesce(m[p], p) WHEN lower(p[3]) = 'x' THEN {hexadecimal} ELSE {number} END"
    return f"replace(array_to_string(list_transform({pieces}, lambda p: {one}), ''), chr(160), ' ')"


def oracle_sql() -> str:
    """The derivatives of the pages table, in DuckDB's SQL, for pages whose references end in semicolons and whose links are in double quotes."""
    uuid = "concat('<urn:uuid:', substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12), '>')"
    literal = lambda x: "'" + x.replace("'", "''") + "'"
    known = {f"&{n}": v for n, v in html5.items() if n.endswith(";")}
    names = f"MAP([{', '.join(map(literal, known))}], [{', '.join(map(literal, known.values()))}])"
    text = f"regexp_replace(regexp_replace(html, '{UNSEEN}', '', 'g'), '{BREAKS}', chr(10), 'g')"
    text = _resolved_sql(f"regexp_replace({text}, '{TAGS}', '', 'g')")
    text = f"regexp_replace(regexp_replace({text}, '[ \\t\\r]*\\n[ \\t\\r\\n]*', chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"
    title = _resolved_sql(f"regexp_extract(html, '{TITLE}', 1)")
    links = f"list_transform(regexp_extract_all(html, '{LINK}', 1), lambda x: {_resolved_sql('x')})"
    return f"""
WITH names AS (SELECT {names} AS m), source AS (
  SELECT page_id, url, html, md5(concat_ws('|', 'response', page_id, url)) AS h,
         concat('sha256:', sha256(html)) AS source_digest,
         concat('HTTP/1.1 200 OK', chr(13), chr(10), 'Content-Type: text/html; charset=utf-8', chr(13), chr(10), 'Content-Length: ', strlen(html)) AS source_headers,
         strftime(make_timestamp((1704067200 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS warc_date,
         {text} AS text, trim({title}) AS title, {links} AS links
  FROM pages, names
), response AS (SELECT *, {uuid} AS refers_to FROM source
), block AS (
  SELECT page_id, refers_to, url, warc_date, source_digest, source_headers, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type, text AS block FROM response
  UNION ALL
  SELECT page_id, refers_to, url, warc_date, source_digest, source_headers, 'metadata', 'application/warc-fields',
         concat('title: ', regexp_replace(title, '\\s+', ' ', 'g'), chr(13), chr(10), 'source-payload-digest: ', source_digest, chr(13), chr(10),
                'source-', replace(source_headers, concat(chr(13), chr(10)), concat(chr(13), chr(10), 'source-')), chr(13), chr(10),
                array_to_string(list_transform(links, lambda x: concat('outlink: ', x, chr(13), chr(10))), ''))
  FROM response
), named AS (SELECT *, md5(concat_ws('|', warc_type, refers_to)) AS h, concat('sha256:', sha256(block)) AS block_digest FROM block
), identified AS (SELECT *, {uuid} AS record_id FROM named)
SELECT page_id, warc_type, record_id, refers_to, url AS target_uri, warc_date, content_type, strlen(block)::BIGINT AS content_length,
       block_digest, source_digest, source_headers,
       concat_ws(concat(chr(13), chr(10)), 'WARC/1.1', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: ' || record_id, 'WARC-Refers-To: ' || refers_to,
                 'WARC-Target-URI: ' || url, 'WARC-Date: ' || warc_date, 'WARC-Block-Digest: ' || block_digest,
                 'Content-Type: ' || content_type, 'Content-Length: ' || strlen(block)) AS headers, block
FROM identified
"""
