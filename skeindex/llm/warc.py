"""WARC derivatives: metadata and plain-text conversion records made from response records.

Both records are made in the row of their response, which they name in ``WARC-Refers-To``; the response's target,
date, HTTP headers and payload digest are carried over. Text is extracted with column functions, so rows never leave
the scan. Records are written as WARC/1.1 files by Spark's text writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeindex.functions.html import decoded as decoded_as_html
from skeindex.functions.html import hrefs
from skeindex.functions.html import visible as visible_part

CRLF = "\r\n"
# Elements that start a new line, and named characters: fixed values.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)
# Tags, which may be cut off by the end of the page; those that start a new line; the title.
TAG = r"<[A-Za-z/!?][^>]*(?:>|\z)"
LINE_TAG = rf"(?i)</?(?:{BLOCKS})\b[^>]*(?:>|\z)"
TITLE = r"(?is)<title\b[^>]*(?:>|\z)(.*?)(?:</title\s*>|\z)"
OWN_NAMES = {n[1:]: c for n, c in ENTITIES if n[1] != "#"}


def decoded(text: Column) -> Column:
    """Character references replaced, each once; names of ENTITIES as given there."""
    return decoded_as_html(text, OWN_NAMES)


# Runs of white space other than one space: what is one space already stays, so few places are rewritten.
_RUNS = r"[\t\r\n\f][ \t\r\n\f]*+| [ \t\r\n\f]++"


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _RUNS, " "))


def plain_text(visible: Column) -> Column:
    """The text of HTML without hidden parts: one line per block element, single spaces, no blank lines."""
    text = F.regexp_replace(visible, _RUNS, " ")
    text = F.regexp_replace(F.regexp_replace(text, LINE_TAG, "\n"), TAG, "")
    return F.btrim(F.regexp_replace(decoded(text), r" *+\n[ \n]*+", "\n"), F.lit(" \n"))


def labelled_digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def record_id(*parts: Column) -> Column:
    """A record id that depends on the parts only, as ``<urn:uuid:...>``."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    groups = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of fetched pages ``(page_id, url, html)``; null html is an empty body, null url an empty target."""
    body, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    size = F.octet_length(body).cast("string")
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF))
    return pages.select(
        "page_id", record_id(F.lit("response"), F.col("page_id"), url).alias("record_id"), url.alias("target_uri"),
        F.lit(date).alias("date"), headers.alias("http_headers"), labelled_digest(body).alias("payload_digest"), body.alias("body"),
    )


def derive(found: DataFrame) -> DataFrame:
    """Two rows for every response: its metadata record and its conversion record.

    Columns: ``page_id, record_type, record_id, refers_to, target_uri, date, content_type, source_headers,
    source_digest, block_digest, content_length, block``. The metadata block has the title, the number of links and the
    links in order; the conversion block is the plain text, empty for an empty body. ``content_length`` counts bytes.
    Repeated responses give repeated records with the same ids; an empty table gives an empty result.
    """
    rows = found.withColumn("visible", visible_part(F.col("body")))
    rows = rows.withColumns({"text": plain_text(F.col("visible")), "links": hrefs(F.col("visible"))})
    title = one_line(decoded(F.regexp_extract("visible", TITLE, 1)))
    links = F.transform("links", lambda x: F.concat(F.lit("outlink: "), one_line(decoded(x))))
    meta = F.concat_ws(CRLF, F.concat(F.lit("title: "), title), F.concat(F.lit("outlinks: "), F.size("links").cast("string")), links)

    def record(kind: str, content_type: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("record_type"), F.lit(content_type).alias("content_type"), block.alias("block"))

    made = F.array(record("metadata", "application/warc-fields", F.concat(meta, F.lit(CRLF))), record("conversion", "text/plain; charset=UTF-8", F.col("text")))
    kept = ("page_id", "record_id", "target_uri", "date", "http_headers", "payload_digest")
    rows = rows.select(*kept, F.explode(made).alias("r"))
    return rows.select(
        "page_id", "r.record_type", record_id(F.col("r.record_type"), F.col("record_id")).alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "date", "r.content_type", F.col("http_headers").alias("source_headers"), F.col("payload_digest").alias("source_digest"),
        labelled_digest(F.col("r.block")).alias("block_digest"), F.octet_length("r.block").cast("long").alias("content_length"), "r.block",
    )


def record_text(row_type: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """A whole WARC record without the line breaks that end it; fields that are null or empty are left out."""
    named = [("WARC-Type", row_type), *fields, ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.when(F.length(value) > 0, F.concat(F.lit(f"{name}: "), value)) for name, value in named]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF + CRLF), block)


def write_records(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write the rows of :func:`derive` as WARC files, one per task."""
    # Line breaks would end a field: the HTTP headers go on folded lines, elsewhere breaks become spaces.
    folded = F.regexp_replace(F.regexp_replace("source_headers", r"[\r\n]+$", ""), r"[\r\n]+", CRLF + " ")
    uri = F.regexp_replace("target_uri", r"[\r\n]+", " ")
    fields = [
        ("WARC-Record-ID", F.col("record_id")), ("WARC-Refers-To", F.col("refers_to")), ("WARC-Target-URI", uri),
        ("WARC-Date", F.col("date")), ("WARC-Block-Digest", F.col("block_digest")), ("WARC-Source-Payload-Digest", F.col("source_digest")),
        ("WARC-Source-Headers", folded), ("Content-Type", F.col("content_type")),
    ]
    text = record_text(F.col("record_type"), fields, F.col("block"))
    records.select(text.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def read_records(spark: SparkSession, path: str, version: str = "WARC/1.1") -> DataFrame:
    """Records of WARC files as ``fields`` (map, lower-case names), ``block`` and ``whole``.

    Files are read record by record. ``whole`` is false where the block is shorter than Content-Length says: a cut file,
    or a block that holds the version line itself.
    """
    rows = spark.read.option("lineSep", version + CRLF).text(path).where(F.length("value") > 0)
    rows = rows.select(F.split("value", CRLF + CRLF, 2).alias("x")).where(F.size("x") == 2)
    lines = F.split(F.regexp_replace(F.col("x")[0], r"\r\n[ \t]+", "\n"), CRLF)
    pairs = F.transform(lines, lambda x: F.split(x, ": ?", 2))
    fields = F.map_from_entries(F.transform(F.filter(pairs, lambda p: F.size(p) == 2), lambda p: F.struct(F.lower(p[0]), p[1])))
    rows = rows.select(fields.alias("fields"), F.col("x")[1].cast("binary").alias("rest"))
    size = F.col("fields")["content-length"].cast("int")
    block = F.substring("rest", F.lit(1), F.coalesce(size, F.lit(0))).cast("string")
    return rows.select("fields", block.alias("block"), (F.octet_length("rest") >= size).alias("whole"))


def responses_of(records: DataFrame) -> DataFrame:
    """Response rows, as :func:`derive` takes them, of the response records of :func:`read_records`.

    ``page_id`` is the record's id; a block without the empty line that ends the HTTP headers is all headers.
    """
    field = lambda name: F.coalesce(F.col("fields")[name], F.lit(""))
    parts = F.split("block", CRLF + CRLF, 2)
    body = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    return records.where((F.col("fields")["warc-type"] == "response") & F.col("whole")).select(
        field("warc-record-id").alias("page_id"), field("warc-record-id").alias("record_id"), field("warc-target-uri").alias("target_uri"),
        field("warc-date").alias("date"), F.concat(parts[0], F.lit(CRLF)).alias("http_headers"),
        F.coalesce(F.col("fields")["warc-payload-digest"], labelled_digest(body)).alias("payload_digest"), body.alias("body"),
    )
