"""WARC archives written and read by Spark, and captures assembled from their records.

Writing: every page becomes a request, a response (or revisit) and a metadata
record; request and metadata name the response in ``WARC-Concurrent-To``. Of
pages with equal payloads the one with the smallest id stores the payload, the
others are revisits. Records go through Spark's text writer (record end as line
separator, gzip), so archives lie on any file system Spark writes to and a
retried task replaces its own files.

Reading: the version line that opens a record is the line separator of Spark's
text reader, so records stream and none needs a whole archive in memory. A block
that holds the version line itself is written with chunked transfer encoding, cut
inside that line, and joined again on reading. ``Content-Length`` delimits every
block; a record shorter than it says is an error.

Assembly: responses meet their request and metadata by joins on the concurrent-to
identifier; one nested row per capture.

Defined results: NULL html is the empty payload; a NULL url gets an empty target;
a NULL id writes no id field and reads back as NULL. Rows that repeat the smallest
id of a payload are all responses; a payload whose ids are all NULL is stored each
time. Other columns are ignored; an empty table gives empty archives.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidystar.llm.common import cut_lineage
from tidystar.session import scratch_path

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
RECORDS_PER_ARCHIVE = 60_000
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1: 8 groups of 20 bits, each five hex and four base32 digits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _lines(*pairs) -> Column:
    """Header lines; a pair whose value is NULL is left out."""
    return F.concat(*(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
                      for name, value in pairs))


def _record(kind: Column | str, record_id: Column, date: str, block: Column, content_type: str, *more) -> Column:
    head = _lines(("WARC-Type", F.lit(kind) if isinstance(kind, str) else kind),
                  ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), record_id, F.lit(">"))),
                  ("WARC-Date", F.lit(date)), *more, ("Content-Type", F.lit(content_type)),
                  ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit(VERSION), head, F.lit("\r\n"), block)


def _chunked(payload: Column) -> Column:
    """The payload in chunks cut inside every version line."""
    parts = F.split(payload, r"(?<=WARC/1\.)(?=1\r\n)")
    framed = F.transform(parts, lambda p: F.concat(F.hex(F.octet_length(p)), F.lit("\r\n"), p, F.lit("\r\n")))
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def _unchunked(body: Column) -> Column:
    """Join the chunks of a body (binary)."""
    steps = F.sequence(F.lit(0), F.length(F.regexp_replace(body.cast("string"), r"[^\n]", "")))

    def step(state, _):
        line = F.locate("\r\n", state["rest"].cast("string"))
        size = F.coalesce(F.conv(F.substring(state["rest"], F.lit(1), line - 1).cast("string"), 16, 10).cast("int"),
                          F.lit(0))
        return F.struct(F.substring(state["rest"], line + 2 + size + 2, F.length(state["rest"])).alias("rest"),
                        F.concat(state["out"], F.substring(state["rest"], line + 2, size)).alias("out"))

    return F.aggregate(steps, F.struct(body.alias("rest"), F.lit(b"").alias("out")), step)["out"]


def duplicate_payloads(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, bytes, first): payloads that several rows share, with the smallest page_id."""
    return pages.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes") \
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")


def write_archives(spark: SparkSession, pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", date: str | None = None) -> None:
    """Write the records of all pages under ``path``."""
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload")) \
        .withColumn("bytes", F.octet_length("payload").cast("bigint")) \
        .withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    shared = cut_lineage(spark, duplicate_payloads(rows, min_bytes), "payloads")
    rows = rows.join(shared, ["digest", "bytes"], "left") \
        .withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first"))
                    .otherwise(F.when(F.col("page_id").isNull(), F.col("first")))) \
        .withColumn("id", F.expr("uuid()")).withColumn("request_id", F.expr("uuid()")) \
        .withColumn("metadata_id", F.expr("uuid()"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    rest = F.regexp_extract(target, r"^[^:]*://(.*)$", 1)
    host, where = F.regexp_extract(rest, r"^([^/?#]*)", 1), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1)
    concurrent = ("WARC-Concurrent-To", F.concat(F.lit("<urn:uuid:"), F.col("id"), F.lit(">")))
    uri = ("WARC-Target-URI", target)

    inner = F.col("payload").contains(VERSION)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.when(inner & ~revisit, F.lit("Transfer-Encoding: chunked\r\n")).otherwise(
                        F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n"))),
                    F.lit("\r\n"))
    body = F.when(revisit, F.lit("")).when(inner, _chunked(F.col("payload"))).otherwise(F.col("payload"))
    response = _record(
        F.when(revisit, "revisit").otherwise("response"), F.col("id"), date, F.concat(http, body),
        "application/http;msgtype=response", uri, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, _REVISIT_PROFILE)), ("Refers-To-Page", F.col("refers_to").cast("string")))
    request = _record(
        "request", F.col("request_id"), date,
        F.concat(F.lit("GET "), F.when(where == "", "/").otherwise(where), F.lit(" HTTP/1.1\r\nHost: "), host,
                 F.lit("\r\n\r\n")), "application/http;msgtype=request", uri, concurrent)
    metadata = _record("metadata", F.col("metadata_id"), date, _lines(("page-id", F.col("page_id").cast("string"))),
                       "application/warc-fields", uri, concurrent)
    rows.select(F.explode(F.array(request, response, metadata)).alias("value")) \
        .write.option("lineSep", END).option("compression", "gzip") \
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: type, ids, headers, and for HTTP responses the payload, its size and digest."""
    text = spark.read.schema("value string").option("lineSep", VERSION).text(path).where("value <> ''")

    def field(source, name):
        found = F.regexp_extract(source, rf"(?mi)^{name}:[ \t]*([^\r\n]*)\r?$", 1)
        return F.when(found != "", found)

    cut = F.locate(END, F.col("value"))
    rows = text.select(F.expr(f"substring(value, 1, locate('{_sql(END)}', value) + 1)").alias("head"),
                       F.col("value").substr(cut + 4, F.length("value")).alias("rest"))
    size = field(F.col("head"), "Content-Length").cast("int")
    whole = F.octet_length("rest") >= size
    rows = rows.select(
        "head", "rest", F.when(whole, size).otherwise(F.raise_error(F.lit("a WARC record is shorter than its length")))
        .cast("int").alias("size"),
        field(F.col("head"), "WARC-Type").alias("type"), field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        field(F.col("head"), "WARC-Concurrent-To").alias("concurrent_to"),
        field(F.col("head"), "WARC-Target-URI").alias("uri"),
        F.regexp_extract(F.coalesce(field(F.col("head"), "WARC-Payload-Digest"), F.lit("")), r"sha1:(\w+)", 1)
        .alias("stated_digest"),
        field(F.col("head"), "Refers-To-Page").cast("bigint").alias("refers_to"))
    block = F.substring(F.col("rest").cast("binary"), F.lit(1), F.col("size"))
    rows = rows.withColumn("block", block).withColumn("http_end", F.locate(END, F.col("rest")))
    http = F.substring(F.col("rest"), F.lit(1), F.col("http_end") + 1)
    body = F.substring(F.col("block"), F.col("http_end") + 4, F.col("size"))
    chunked = F.coalesce(F.lower(field(http, "Transfer-Encoding")) == "chunked", F.lit(False))
    rows = rows.withColumn("payload", F.when(
        F.col("type") == "response", F.when(chunked, _unchunked(body)).otherwise(body)))
    return rows.select(
        "type", "record_id", "concurrent_to", "uri", "head", "block", "payload", "refers_to",
        F.when(F.col("type") == "response", F.length("payload"))
        .otherwise(field(http, "Content-Length")).cast("bigint").alias("payload_bytes"),
        F.when(F.col("type") == "response", base32_sha1(F.col("payload")))
        .otherwise(F.col("stated_digest")).alias("payload_digest"))


def _sql(text: str) -> str:
    return text.replace("\r", "\\r").replace("\n", "\\n")


def assemble_captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit with its request and metadata as nested columns.

    Of several requests (or metadata records) that name one response the one with
    the smallest record id is taken.
    """
    responses = records.where(F.col("type").isin("response", "revisit"))

    def partner(kind, *fields):
        own = records.where(F.col("type") == kind)
        return own.groupBy("concurrent_to").agg(F.min(F.struct("record_id", *fields)).alias(kind))

    r = responses.alias("r")
    joined = r.join(partner("request", "uri").alias("q"), F.col("r.record_id") == F.col("q.concurrent_to"), "left") \
        .join(partner("metadata", F.col("block").cast("string").alias("fields")).alias("m"),
              F.col("r.record_id") == F.col("m.concurrent_to"), "left")
    return joined.select(F.struct(
        F.col("r.record_id"), F.col("r.type"), F.col("r.uri"), F.col("r.refers_to"), F.col("r.payload_bytes"),
        F.col("r.payload_digest"), F.col("r.payload")).alias("response"), "request", "metadata")


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages under the shared folder and return the captures read back."""
    path = scratch_path(spark, "warc")
    write_archives(spark, pages, path, min_bytes)
    return assemble_captures(read_records(spark, path))


def capture_digest(captures: DataFrame) -> DataFrame:
    page = F.regexp_extract("metadata.fields", r"(?m)^page-id: (-?\d+)", 1)
    return captures.select(
        F.when(page != "", page).cast("bigint").alias("page_id"), F.col("response.payload_bytes"),
        F.col("response.payload_digest"), F.col("response.type").alias("record_type"), F.col("response.refers_to"))
