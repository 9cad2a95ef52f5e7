"""WARC derivatives: linked metadata and plain-text conversion records of responses.

Everything is a projection over the response records: one scan gives both
derivatives, and files are written by Spark's text writer, whose line separator
is the blank lines that end a WARC record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.session import shared_dir

# The record format, and block-level elements that end a line.
VERSION = "WARC/1.1"
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
CAPTURE_DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BLOCKS = "p|div|br|li|ul|ol|tr|table|h1|h2|h3|h4|h5|h6|header|footer|nav|section|article|aside|main|title|blockquote|pre|hr|form|option"
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&#160;": " ",
    "&mdash;": "—", "&ndash;": "–", "&hellip;": "…", "&copy;": "©", "&reg;": "®", "&euro;": "€",
    "&amp;": "&",
}
#: Removed with their content, then comments, then remaining tags.
DROPPED = r"(?is)<(script|style|noscript|template|svg)\b[^>]*>.*?</(script|style|noscript|template|svg)\s*>"
COMMENT = r"(?s)<!--.*?-->"
BLOCK_TAG = rf"(?i)</?({BLOCKS})(\s[^>]*)?/?>"
TAG = r"<[/!?a-zA-Z][^>]*>"
#: Runs of white space but for a single space, which is left as it is.
SPACES = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def plain_text(html: Column) -> Column:
    """Visible text: a line per block element, single spaces, no empty lines."""
    text = F.regexp_replace(html, DROPPED, " ")
    text = F.regexp_replace(text, COMMENT, " ")
    text = F.regexp_replace(text, SPACES, " ")
    text = F.regexp_replace(text, BLOCK_TAG, "\n")
    text = F.regexp_replace(text, TAG, "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(text, " *\n[ \n]*", "\n")
    text = F.regexp_replace(text, " {2,}", " ")
    return F.regexp_replace(text, "^[ \n]+|[ \n]+$", "")


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(kind: str, *parts: Column) -> Column:
    """A name-based identifier: the same input gives the same record."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *parts))
    cut = [F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of ``page_id, url, html``: a missing page or address is an empty one.

    Line ends in an address are taken out, as header lines cannot hold them.
    """
    html = F.coalesce("html", F.lit(""))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")
    block = F.concat(F.lit(HTTP_HEAD), html)
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        record_id("response", F.col("page_id").cast("string"), url, html).alias("record_id"),
        url.alias("target_uri"),
        F.lit(CAPTURE_DATE).alias("date"),
        digest(html).alias("payload_digest"),
        digest(block).alias("block_digest"),
        F.lit(HTTP_HEAD).alias("http_head"),
        html.alias("payload"),
    )


def _headers(fields: list[tuple[str, Column | str]]) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v)) for name, v in fields]
    return F.concat_ws(CRLF, F.lit(VERSION), *lines)


def derivatives(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response, each pointing back to it.

    ``page_id, kind, record_id, refers_to, headers, block, block_digest``.  The
    metadata block has the source's HTTP header lines, digests and sizes and
    the id of the conversion; the conversion block is the page's plain text.
    """
    parent = F.col("record_id")
    texted = records.select("*", plain_text(F.col("payload")).alias("plain"))
    named = texted.select(
        "*",
        record_id("conversion", parent).alias("conversion_id"),
        record_id("metadata", parent).alias("metadata_id"),
        F.octet_length("plain").cast("string").alias("plain_bytes"),
        digest(F.col("plain")).alias("plain_digest"),
    )
    fields = F.concat_ws(
        CRLF,
        F.concat(F.lit("source-payload-digest: "), "payload_digest"),
        F.concat(F.lit("source-block-digest: "), "block_digest"),
        F.concat(F.lit("source-payload-length: "), F.octet_length("payload").cast("string")),
        F.concat(F.lit("conversion-record-id: "), "conversion_id"),
        F.concat(F.lit("conversion-length: "), "plain_bytes"),
        F.concat(F.lit("conversion-digest: "), "plain_digest"),
        F.regexp_replace(F.regexp_replace("http_head", "\r\n(\r\n)?$", ""), "(?m)^", "source-header: "),
    )
    meta = named.withColumn("fields", F.concat(fields, F.lit(CRLF)))

    def record(kind: str, own: str, block: str, mime: str) -> Column:
        block_digest = digest(F.col(block))
        headers = _headers(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", F.col(own)),
                ("WARC-Refers-To", parent),
                ("WARC-Refers-To-Target-URI", F.col("target_uri")),
                ("WARC-Refers-To-Date", F.col("date")),
                ("WARC-Target-URI", F.col("target_uri")),
                ("WARC-Date", F.col("date")),
                ("WARC-Source-Payload-Digest", F.col("payload_digest")),
                ("WARC-Block-Digest", block_digest),
                ("Content-Type", mime),
                ("Content-Length", F.octet_length(block).cast("string")),
            ]
        )
        return F.struct(
            F.lit(kind).alias("kind"), F.col(own).alias("record_id"), parent.alias("refers_to"),
            headers.alias("headers"), F.col(block).alias("block"), block_digest.alias("block_digest"),
        )

    both = F.array(
        record("metadata", "metadata_id", "fields", "application/warc-fields"),
        record("conversion", "conversion_id", "plain", "text/plain; charset=utf-8"),
    )
    return meta.select("page_id", F.explode(both).alias("r")).select("page_id", "r.*")


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of ``headers, block``, one per partition; a record never spans files."""
    text = F.concat("headers", F.lit(CRLF + CRLF), "block")
    records.select(text.alias("value")).write.option("lineSep", RECORD_END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``headers, block`` of files as ``write_warc`` writes them.

    A record starts after the end of another with the version line.  Blocks of
    derivatives cannot hold that: plain text has no carriage returns, and
    metadata has no empty lines.
    """
    marker = RECORD_END + VERSION + CRLF
    pieces = spark.read.option("lineSep", marker).text(path)
    body = F.regexp_replace("value", f"^{VERSION}\r\n", "")
    cut = F.locate(RECORD_END, body)
    return pieces.select(
        F.concat(F.lit(VERSION + CRLF), F.substr(body, F.lit(1), cut - 1)).alias("headers"),
        # The last record of a file still has its end mark.
        F.regexp_replace(F.substr(body, cut + 4, F.length(body)), "\r\n\r\n\\z", "").alias("block"),
    )


def header(headers: Column | str, name: str) -> Column:
    return F.regexp_extract(headers, rf"\r\n{name}: ([^\r\n]*)", 1)


def derivative_summary(records: DataFrame) -> DataFrame:
    """What read records say of themselves, with digests and lengths taken anew from the blocks."""
    return records.select(
        header("headers", "WARC-Type").alias("kind"),
        header("headers", "WARC-Record-ID").alias("record_id"),
        header("headers", "WARC-Refers-To").alias("refers_to"),
        header("headers", "WARC-Target-URI").alias("target_uri"),
        header("headers", "WARC-Source-Payload-Digest").alias("source_digest"),
        header("headers", "Content-Length").cast("long").alias("content_length"),
        F.octet_length("block").cast("long").alias("n_bytes"),
        digest(F.col("block")).alias("block_digest"),
        (header("headers", "WARC-Block-Digest") == digest(F.col("block"))).alias("intact"),
    )


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_warc(derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet"))), path)
    return derivative_summary(read_warc(spark, path))


def _uuid_sql(kind: str, *parts: str) -> str:
    h = f"md5(concat_ws(chr(10), '{kind}', {', '.join(parts)}))"
    cut = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cut} || '>'"


def _plain_sql(html: str) -> str:
    quote = lambda t: t.replace("'", "''")
    text = html
    for pattern, by in ((DROPPED, " "), (COMMENT, " "), (SPACES, " "), (BLOCK_TAG, "\n"), (TAG, "")):
        text = f"regexp_replace({text}, '{quote(pattern)}', '{by}', 'g')"
    for entity, char in ENTITIES.items():
        text = f"replace({text}, '{quote(entity)}', '{quote(char)}')"
    for pattern, by in ((" *\n[ \n]*", "\n"), (" {2,}", " "), ("^[ \n]+|[ \n]+$", "")):
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return text


_CRLF_SQL = "chr(13) || chr(10)"
_HEAD_SQL = "'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || chr(13) || chr(10)"

WARC_SQL = f"""
WITH pages_ AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), response AS (
  SELECT *, {_uuid_sql('response', 'page_id::VARCHAR', 'url', 'html')} AS parent,
    'sha256:' || sha256(html) AS payload_digest,
    'sha256:' || sha256({_HEAD_SQL} || html) AS source_block_digest,
    {_plain_sql('html')} AS plain
  FROM pages_
), named AS (
  SELECT *, {_uuid_sql('conversion', 'parent')} AS conversion_id, {_uuid_sql('metadata', 'parent')} AS metadata_id
  FROM response
), fields AS (
  SELECT *, concat_ws({_CRLF_SQL},
    'source-payload-digest: ' || payload_digest,
    'source-block-digest: ' || source_block_digest,
    'source-payload-length: ' || octet_length(encode(html)),
    'conversion-record-id: ' || conversion_id,
    'conversion-length: ' || octet_length(encode(plain)),
    'conversion-digest: sha256:' || sha256(plain),
    'source-header: HTTP/1.1 200 OK',
    'source-header: Content-Type: text/html; charset=utf-8') || {_CRLF_SQL} AS meta
  FROM named
), records AS (
  SELECT 'metadata' AS kind, metadata_id AS record_id, parent, url, payload_digest, meta AS block FROM fields
  UNION ALL
  SELECT 'conversion', conversion_id, parent, url, payload_digest, plain FROM fields
)
SELECT kind, record_id, parent AS refers_to, url AS target_uri, payload_digest AS source_digest,
  octet_length(encode(block))::BIGINT AS content_length, octet_length(encode(block))::BIGINT AS n_bytes,
  'sha256:' || sha256(block) AS block_digest, true AS intact
FROM records
"""
