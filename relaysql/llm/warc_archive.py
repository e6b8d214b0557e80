"""Operator 9: a content-addressed WARC archive.

``write_archive`` splits WARC records in two tables under one folder:

* ``payloads``: every distinct payload once, keyed by its SHA-256, with the
  smallest page id that has it. Equal digests are proved to be equal bytes with
  a second hash and the length before anything is stored.
* ``headers``: one row per record, the exact header block as it stands in a
  WARC 1.1 file, and the digest that leads to the payload.

``read_archive`` parses the stored header blocks; ``restore`` joins the two and
gives back whole records. The payload shuffle is combined on the map side, so a
payload that a third of all pages share moves once per task; the join of the
headers has plain shuffles on both sides, which AQE splits when one digest is hot.

Null html is an empty payload, a null url leaves its header out (line breaks in
a url are percent-encoded), repeated rows each get a record, an empty table
gives an empty archive. Rows with a null page id are written too; they are a
response when nothing with an id has the same payload. Several rows with the
smallest id are all responses. Columns other than the three are not read.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import table
from relaysql.session import shared_path

MIN_REVISIT_BYTES = 100      # smaller payloads are never revisits
WARC_DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
# Every character that Unicode counts as a line break.
LINE_BREAKS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def _record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), page_id.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12)), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing when the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date: str = WARC_DATE) -> str:
    """Archive ``pages`` under ``path`` (two Parquet tables); returns ``path``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    records = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        payload.alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))

    distinct = records.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_page_id"), F.any_value("payload").alias("payload"),
        F.min(F.xxhash64("payload")).alias("lo"), F.max(F.xxhash64("payload")).alias("hi"),
        F.min(F.octet_length("payload")).alias("payload_bytes"), F.max(F.octet_length("payload")).alias("longest"))
    proved = (F.col("lo") == F.col("hi")) & (F.col("payload_bytes") == F.col("longest"))
    distinct.select(
        "payload_digest", "first_page_id", F.col("payload_bytes").cast("bigint").alias("payload_bytes"),
        F.when(proved, F.col("payload")).otherwise(
            F.raise_error(F.lit("two payloads have one SHA-256 digest")).cast("binary")).alias("payload"),
    ).write.option("compression", "zstd").parquet(f"{path}/payloads")

    index = spark.read.parquet(f"{path}/payloads").select("payload_digest", "first_page_id", "payload_bytes")
    joined = records.drop("payload").join(index, "payload_digest")
    response = ((F.col("payload_bytes") < MIN_REVISIT_BYTES) | F.col("first_page_id").isNull()
                | F.col("page_id").eqNullSafe(F.col("first_page_id")))
    uri = F.col("url")
    for c in LINE_BREAKS:
        uri = F.replace(uri, F.lit(c), F.lit(quote(c)))
    headers = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(response, "response").otherwise("revisit"), F.lit(CRLF),
        _field("WARC-Record-ID", _record_id(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        _field("WARC-Target-URI", uri), F.lit(f"WARC-Date: {date}{CRLF}"),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(response, "").otherwise(F.concat(
            F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"),
            _field("WARC-Refers-To", _record_id(F.col("first_page_id"))),
            _field("X-Refers-To-Page", F.col("first_page_id").cast("string")))),
        _field("X-Page", F.col("page_id").cast("string")),
        _field("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Length: "), F.when(response, F.col("payload_bytes")).otherwise(0).cast("string"),
        F.lit(CRLF + CRLF))
    joined.select("page_id", "payload_digest", headers.alias("headers")).write.parquet(f"{path}/headers")
    return path


def _header(name: str) -> Column:
    # header lines end in CRLF and in nothing else, whatever a url holds
    found = F.regexp_extract("headers", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, everything taken from the stored header blocks."""
    return spark.read.parquet(f"{path}/headers").select(
        _header("X-Page").cast("bigint").alias("page_id"),
        _header("X-Payload-Length").cast("bigint").alias("payload_bytes"),
        F.substring_index(_header("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        _header("WARC-Type").alias("record_type"),
        _header("X-Refers-To-Page").cast("bigint").alias("refers_to"),
        _header("WARC-Target-URI").alias("url"), "headers")


def restore(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: page_id, record (the bytes of the WARC record; a revisit has
    no block), payload (the page's bytes, for revisits those of the response)."""
    payloads = spark.read.parquet(f"{path}/payloads").select("payload_digest", "payload")
    crlf2 = F.lit(CRLF + CRLF).cast("binary")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return read_archive(spark, path).join(payloads, "payload_digest").select(
        "page_id", "record_type",
        F.concat(F.col("headers").cast("binary"), block, crlf2).alias("record"), "payload")


def verified(spark: SparkSession, path: str) -> DataFrame:
    """``read_archive`` with length and digest taken anew from the stored payloads.
    Each payload is hashed once; the join moves only its digest and length."""
    stored = spark.read.parquet(f"{path}/payloads").select(
        F.col("payload_digest").alias("key"), F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    heads = read_archive(spark, path).select("page_id", F.col("payload_digest").alias("key"), "record_type", "refers_to")
    return heads.join(stored, "key").drop("key")


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archive(table(spark, sf_dir, "pages"), shared_path(spark, "llm", "warc"))
    return verified(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n < 100 OR first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id
            THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT (n < 100 OR first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id)
            THEN first_id END AS refers_to
FROM f
"""
