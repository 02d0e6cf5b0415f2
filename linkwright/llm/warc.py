"""WARC archives: revisit resolution, writing with fresh headers, and reading back."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.shared import materialize, new_path

#: The archive format's version, profile of revisits, and the HTTP status line written before a payload.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STATUS = "HTTP/1.1 200 OK"
EOL = "\r\n"

RECORD = "page_id string, record_id string, record_type string, uri string, payload_digest string, payload_bytes long, refers_to_record string"


def resolve(pages: DataFrame, *, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """id, digest, original (struct of id and url) of every page whose payload another page stands for: rows of headers only.

    Of pages with equal payloads of at least min_bytes bytes, the one with the smallest id stays. The originals are
    aggregated before their shuffle; the headers that join them are rows of some 50 bytes, and a skewed digest is split.
    """
    text = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    headers = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.sha2(text, 256).alias("digest"), F.octet_length(text).alias("n"))
    headers = headers.where(F.col("n") >= min_bytes)
    originals = headers.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("o"), F.min_by("url", "id").alias("ourl"), F.max("id").alias("last")).where("o < last")
    return headers.join(originals.drop("last"), "digest").where("id > o").select("id", "digest", F.struct(F.col("o").alias("id"), F.col("ourl").alias("url")).alias("original")).distinct()


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 100, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 4000) -> None:
    """One record per page below path, in gzipped archives of at most records_per_file records.

    A payload is the page's html in UTF-8, empty where it is null. Pages that repeat an earlier page's payload become
    revisit records, which carry the digest and name of the original and no payload; all others are responses. Pages
    with a null id are never an original nor a revisit; rows that repeat an original's id and payload are responses too.
    An empty table writes no record. Only id_col, url_col and html_col are read.

    The payloads are shuffled once, by id; everything before that moves headers only. Spark's own writer commits the
    files, so a lost executor's half-written ones never count.
    """
    text = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    again = resolve(pages, id_col=id_col, url_col=url_col, html_col=html_col, min_bytes=min_bytes)
    body = pages.select(F.col(f"`{id_col}`").alias("pid"), F.col(f"`{url_col}`").cast("string").alias("purl"), text.alias("html"), F.sha2(text, 256).alias("d"))
    rows = body.join(again, (F.col("pid") == again["id"]) & (F.col("d") == again["digest"]), "left")
    twice = F.col("original").isNotNull()
    clean = lambda u: F.regexp_replace(F.coalesce(u, F.lit("")), r"[\r\n]+", " ")
    http = F.concat(F.lit(STATUS + EOL + "Content-Type: text/html; charset=utf-8" + EOL + "Content-Length: "), F.octet_length("html").cast("string"), F.lit(EOL + EOL))
    block = F.when(twice, http).otherwise(F.concat(http, F.col("html")))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
    refers = F.concat(
        field("WARC-Profile", F.lit(PROFILE)),
        field("WARC-Refers-To", record_id(F.col("original.id"), F.col("d"))),
        field("WARC-Refers-To-Target-URI", clean(F.col("original.url"))),
        field("WARC-Refers-To-Date", F.lit(date)),
    )
    head = F.concat(
        F.lit(VERSION + EOL),
        field("WARC-Type", F.when(twice, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", record_id(F.col("pid"), F.col("d"))),
        field("WARC-Page-ID", F.coalesce(F.col("pid").cast("string"), F.lit(""))),
        field("WARC-Target-URI", clean(F.col("purl"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("d"))),
        F.when(twice, refers).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(EOL),
    )
    rows.select(F.concat(head, block).alias("value")).write.option("compression", "gzip").option("lineSep", EOL * 2).option("maxRecordsPerFile", records_per_file).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers (lower-case names) and the block of each record of an archive, by their stated lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(EOL)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts at byte {at}")
        head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        n = int(head["content-length"])
        block = data[end + 4 : end + 4 + n]
        if len(block) < n:
            raise ValueError(f"the record at byte {at} is cut short")
        yield head, block
        at = end + 4 + n + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record below path. A response's digest and length are those of the payload as read; a digest that
    differs from the header's raises. A revisit has the header's digest, no length, and the record that it refers to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for head, block in parse(gzip.decompress(content.as_py())):
                    digest, kind, n = head["warc-payload-digest"].removeprefix("sha256:"), head["warc-type"], None
                    if kind == "response":
                        payload = memoryview(block)[block.index(b"\r\n\r\n") + 4 :]
                        n = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{head['warc-record-id']}: the payload differs from its digest")
                    rows.append((head["warc-page-id"] or None, head["warc-record-id"], kind, head["warc-target-uri"], digest, n, head.get("warc-refers-to")))
                if rows:
                    types = [pa.string()] * 5 + [pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def resolve_records(records: DataFrame) -> DataFrame:
    """Records with the page and the payload's length of the response that each revisit refers to: refers_to, payload_bytes."""
    first = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("rid")).agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("n"))
    joined = records.where("record_type = 'revisit'").join(first, F.col("refers_to_record") == F.col("rid"), "left")
    columns = ["page_id", "record_id", "record_type", "uri", "payload_digest"]
    return records.where("record_type = 'response'").select(*columns, "payload_bytes", F.lit(None).cast("string").alias("refers_to")).unionByName(joined.select(*columns, F.col("n").alias("payload_bytes"), "refers_to"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    out = resolve_records(materialize(read_archives(spark, path), "records"))
    return out.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS d FROM p),
o AS (SELECT d, min(page_id) AS o FROM q WHERE n >= 100 GROUP BY d)
SELECT q.page_id, q.n AS payload_bytes, q.d AS payload_digest,
       CASE WHEN o.o < q.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.o < q.page_id THEN o.o END AS refers_to
FROM q LEFT JOIN o ON q.d = o.d AND q.n >= 100
"""
