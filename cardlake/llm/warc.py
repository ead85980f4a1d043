"""Content-addressed WARC archive.

``write_archive`` stores each distinct payload once, under its SHA-256, and every record's
exact header bytes (WARC fields and HTTP head, all bytes in front of the payload) in a
table of their own. ``read_archive`` joins the two and gives back the original records.
That the digest stands for one payload only is verified while storing: the smallest and
the largest payload of a digest must be the same bytes, else the write fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import col, utf8

MIN_REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"   # capture date of a synthetic crawl
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """urn:uuid made from what the record is about, so that rewriting gives the same id."""
    h = F.md5(F.to_json(F.struct(page_id.alias("p"), url.alias("u"), digest.alias("d"))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, path: str, html_col: str = "html", url_col: str = "url", id_col: str = "page_id",
                  min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write ``path``/payloads (digest, payload) and ``path``/headers (digest, header).

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the
    largest page_id is the response (rows repeating that page_id too), the others are revisits
    that refer to it; if all ids are null, all are responses. Smaller payloads are always
    responses. Null html is an empty payload; a null url or page_id leaves its field out; line
    breaks in a url are percent-encoded. An empty table writes empty tables.
    """
    payload = utf8(html_col)
    rows = pages.select(
        col(id_col).cast("long").alias("page_id"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
        F.replace(F.replace(col(url_col).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"))
    # both sides combine map-side: a payload shared by a third of all rows moves once per task
    same = F.assert_true(F.min("payload") == F.max("payload"), F.lit("two payloads have one SHA-256 digest"))
    rows.groupBy("digest").agg(F.min("payload").alias("payload"), same.alias("same")).where("same is null").select(
        "digest", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")

    heads = rows.select("page_id", "url", "digest", F.sha1("payload").alias("sha1"), F.length("payload").alias("n"))
    newest = (heads.where(F.col("n") >= min_revisit_bytes).where("page_id is not null").groupBy("digest")
              .agg(F.max(F.struct("page_id", "url")).alias("newest")))
    heads = heads.join(newest, "digest", "left")
    response = F.col("newest").isNull() | F.col("page_id").eqNullSafe(F.col("newest.page_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    _field("Content-Length", F.col("n")), F.lit(CRLF))
    refers = F.when(~response, _record_id(F.col("newest.page_id"), F.col("newest.url"), F.col("digest")))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _field("WARC-Type", F.when(response, "response").otherwise("revisit")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("digest"))),
        _field("WARC-Date", F.lit(DATE)), _field("WARC-Target-URI", F.col("url")), _field("X-Page-ID", F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Refers-To", refers), _field("X-Refers-To-Page-ID", F.when(~response, F.col("newest.page_id"))),
        _field("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _field("Content-Length", F.octet_length(http) + F.when(response, F.col("n")).otherwise(0)), F.lit(CRLF), http)
    heads.select("digest", header.cast("binary").alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")


def _value(name: str) -> Column:
    """Value of a header line of the WARC fields (the first block of the header)."""
    found = F.regexp_extract(F.col("fields"), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, record_id, refers_to (page_id of the response a revisit refers
    to), payload_digest (hex SHA-1 of the full payload, as the header says), payload (full, for
    revisits too), record (the record's exact bytes), verified (the payload has that digest)."""
    headers = spark.read.schema("digest string, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    whole = headers.join(payloads, "digest").withColumn(
        "fields", F.substring_index(F.col("header").cast("string"), f"{CRLF}{CRLF}", 1))
    response = _value("WARC-Type") == "response"
    digest = F.regexp_replace(_value("WARC-Payload-Digest"), "^sha1:", "")
    return whole.select(
        _value("X-Page-ID").cast("long").alias("page_id"), _value("WARC-Target-URI").alias("url"),
        _value("WARC-Type").alias("record_type"), _value("WARC-Record-ID").alias("record_id"),
        _value("X-Refers-To-Page-ID").cast("long").alias("refers_to"), digest.alias("payload_digest"), "payload",
        F.concat(F.col("header"), F.when(response, F.col("payload")).otherwise(F.lit(b"")),
                 F.lit(f"{CRLF}{CRLF}".encode())).alias("record"),
        (F.sha1("payload") == digest).alias("verified"))
