"""WARC archives: write captures as records, read them back, and assemble each transaction.

A capture is a request, a response or revisit, and a metadata record; request and metadata name the
response by WARC-Concurrent-To.  Archives are text parts of a Spark job (gzip), each record followed
by two line ends, so any WARC reader can walk a part by Content-Length.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galemark.llm.common import column, new_path, save, ship, table

#: Payloads of fewer bytes are stored again instead of being referred to.
LEAST_REVISIT = 100
#: Records of one archive file; a file is read by one task.
RECORDS_PER_FILE = 6000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def _id(kind: str, *of: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *(F.coalesce(c.cast("string"), F.lit("-")) for c in of)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record; a field that is null is left out."""
    lines = [F.lit("WARC/1.1")] + [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", *lines, length), F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, path: str, least_revisit: int = LEAST_REVISIT) -> None:
    """Write pages (page_id, url, html) as captures to WARC parts under `path`.

    Payload is the html in UTF-8, a null as an empty one.  Of equal payloads of least_revisit bytes
    or more, the one of smallest page_id is a response and the others are revisits that refer to it;
    a null page_id comes last.  Rows of the same page_id and payload are alike.  Control characters
    in a url are percent-encoded.
    """
    page, html = column(pages, "page_id", "long"), F.coalesce(column(pages, "html", "string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(column(pages, "url", "string"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    rows = pages.select(
        page.alias("page_id"), url.alias("url"), html.alias("html"), F.sha2(F.encode(html, "UTF-8"), 256).alias("digest")
    )
    # One row per digest, from partial minima: a payload that a third of all pages share is no hot task.
    narrow = rows.filter(F.octet_length("html") >= least_revisit).select("digest", "page_id", "url")
    first = narrow.groupBy("digest").agg(
        F.count("*").alias("times"), F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "url")).alias("f")
    )
    again = save(first.filter("times > 1").select(F.col("digest").alias("d"), "f.page_id", "f.url"), "first")
    again = again.select("d", F.col("page_id").alias("first_id"), F.col("url").alias("first_url"))
    joined = rows.join(again, F.col("digest") == F.col("d"), "left").withColumn(
        "revisit", F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    date, digest = F.lit(DATE), F.concat(F.lit("sha256:"), F.col("digest"))
    own = _id("response", F.col("page_id"), F.col("digest"))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", date)]
    response = _record(
        [
            ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), ("WARC-Record-ID", own), *common,
            ("WARC-Payload-Digest", digest), ("X-Page-ID", F.col("page_id").cast("string")),
            ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
            ("WARC-Refers-To", F.when(F.col("revisit"), _id("response", F.col("first_id"), F.col("digest")))),
            ("WARC-Refers-To-Target-URI", F.when(F.col("revisit"), F.col("first_url"))),
            ("WARC-Refers-To-Date", F.when(F.col("revisit"), date)),
            ("Content-Type", F.lit("application/http;msgtype=response")),
        ],
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))),
    )
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _id("request", F.col("page_id"), F.col("digest"))), *common,
         ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _id("metadata", F.col("page_id"), F.col("digest"))), *common,
         ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("payload-bytes: "), F.octet_length("html").cast("string"), F.lit("\r\n")),
    )
    (
        joined.select(F.explode(F.array(request, response, metadata)).alias("value")).write
        .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


RECORD = "type string, id string, concurrent_to string, refers_to string, uri string, page_id long, " \
    "stated_digest string, payload_bytes long, payload_digest string, block string"


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open archive; stops with an error at a broken one."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record ends early")
        yield headers, block


def read_archives(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record; `blocks` keeps the payloads of responses and the blocks of other records."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                raw = io.BytesIO(content.as_buffer())
                stream = gzip.GzipFile(fileobj=raw) if raw.getvalue()[:2] == b"\x1f\x8b" else raw
                out = []
                for headers, block in records_of(stream):
                    kind = headers["warc-type"]
                    body = block.partition(b"\r\n\r\n")[2] if kind in ("response", "revisit") else block
                    page = headers.get("x-page-id")
                    stated = headers.get("warc-payload-digest", "").partition(":")[2] or None
                    out.append((
                        kind, headers["warc-record-id"], headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
                        headers.get("warc-target-uri"), int(page) if page else None, stated, len(body),
                        hashlib.sha256(body).hexdigest(), body.decode("utf-8") if blocks or kind == "metadata" else None,
                    ))
                    if len(out) >= 500:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return files.mapInArrow(parse, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: id, uri, page_id, record_type, response, request, metadata.

    Requests and metadata join the response or revisit that they name as concurrent; those that name
    none are left out.  A capture without a request has a null one; of several requests the one of
    smallest id counts; metadata is a list.  A revisit takes payload size and digest of the response
    it refers to, null if that is not in the archives.  A capture that stands twice gives two rows.
    """
    others = records.filter("type IN ('request', 'metadata')").filter("concurrent_to IS NOT NULL")
    by_capture = others.groupBy(F.col("concurrent_to").alias("capture")).agg(
        F.min(F.when(F.col("type") == "request", F.struct("id", "uri", "block"))).alias("request"),
        F.sort_array(F.collect_set(F.when(F.col("type") == "metadata", F.struct("id", "block")))).alias("metadata"),
    )
    capture = records.filter("type IN ('response', 'revisit')")
    original = records.filter("type = 'response'").groupBy(F.col("id").alias("original")).agg(
        F.first(F.struct("page_id", "payload_bytes", "payload_digest")).alias("of")
    )
    revisits = capture.filter("type = 'revisit'").select("refers_to").distinct()
    original = original.join(revisits, F.col("original") == F.col("refers_to"), "left_semi")
    revisit = F.col("type") == "revisit"
    return (
        capture.join(by_capture, F.col("id") == F.col("capture"), "left")
        .join(original, F.col("refers_to") == F.col("original"), "left")
        .select(
            "id", "uri", "page_id", F.col("type").alias("record_type"),
            F.struct(
                F.when(revisit, F.col("of.payload_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                F.when(revisit, F.col("of.payload_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
                "stated_digest", F.col("of.page_id").alias("refers_to"), F.when(~revisit, F.col("block")).alias("payload"),
            ).alias("response"),
            "request", "metadata",
        )
    )


def op9_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = save(read_archives(spark, path, blocks=False), "records")
    return assemble(records).select(
        "page_id", "response.payload_bytes", "response.payload_digest", "record_type", "response.refers_to",
        F.col("request.id").alias("request_id"), F.size("metadata").cast("long").alias("n_metadata"),
    )


OP9_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= {LEAST_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest)
            ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       '<urn:uuid:' || regexp_replace(md5('request|' || page_id || '|' || payload_digest), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '>' AS request_id,
       1::BIGINT AS n_metadata
FROM f
"""
