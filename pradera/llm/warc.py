"""Content-addressed WARC archive: payload bytes once by digest, exact record headers apart, records by joins.

An archive is two Parquet tables: ``payloads`` (digest, payload: one row per distinct payload) and ``records`` (the
header block of every record, byte for byte, and the digest of its payload).  The address of a payload is its SHA-256
with its SHA-1 and length, and is computed again from the stored bytes on every read.  Of records with equal payloads
of ``least_bytes`` at least, the one with the largest id is the response and the others revisit it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the WARC standard
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ID_PREFIX = "urn:page:"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four base32 digits."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), _DIGITS, BASE32)


def _payload(body: Column) -> Column:
    return F.coalesce(body.cast("binary"), F.lit(b""))


def _header(kind: Column, record_id: Column, refers: Column, uri: Column, date: str, sha1: Column,
            length: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    uri = F.regexp_replace(F.regexp_replace(uri, "\r", "%0D"), "\n", "%0A")  # a line break can't end the header line
    revisit = kind == "revisit"
    empty = F.lit("")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", F.concat(F.lit("<" + ID_PREFIX),
                                                                                          record_id, F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", uri), empty), line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit("<" + ID_PREFIX), refers, F.lit(">"))),
                                 line("WARC-Profile", F.lit(PROFILE)))).otherwise(empty),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
        F.lit(CRLF)).cast("binary")


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archive ``pages`` (page_id, url, html) below ``path``.

    A null body is an empty payload, a null url has no target line, other columns are not read.  Null ids are written
    as ``null`` and are responses only where a payload has no other id; rows that repeat a response's id and payload
    are responses as well (their payload is stored once all the same).  An empty table makes an empty archive.
    """
    body = _payload(F.col("html"))
    rows = pages.select("page_id", "url", F.sha2(body, 256).alias("digest"), base32_sha1(body).alias("sha1"),
                        F.length(body).cast("long").alias("length"))
    key = ["digest", "sha1", "length"]
    # only payloads that occur more than once, and are long enough, have a response to refer to
    shared = (rows.where(F.col("length") >= least_bytes).groupBy(*key)
              .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    rows = rows.join(shared, key, "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumn("kind", F.when(revisit, "revisit").otherwise("response"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    header = _header(F.col("kind"), text("page_id"), text("first_id"), F.col("url"), date, F.col("sha1"),
                     F.col("length"))
    rows.select(header.alias("header"), *key).write.parquet(f"{path}/records")
    (pages.select(F.sha2(body, 256).alias("digest"), base32_sha1(body).alias("sha1"),
                  F.length(body).cast("long").alias("length"), body.alias("payload"))
     .dropDuplicates(key).write.parquet(f"{path}/payloads"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with ``verified``: the bytes have the address that they are stored under."""
    p = spark.read.parquet(f"{path}/payloads")
    ok = ((F.sha2("payload", 256) == F.col("digest")) & (base32_sha1(F.col("payload")) == F.col("sha1"))
          & (F.length("payload") == F.col("length")))
    return p.withColumn("verified", ok)


def header_field(header: Column, name: str) -> Column:
    """Value of a header line, null if the header has none."""
    value = F.regexp_extract(header.cast("string"), f"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(value != "", value)


def _id(value: Column) -> Column:
    return F.regexp_extract(value, f"<{ID_PREFIX}(-?[0-9]+)>", 1).try_cast("long")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records as their headers say: ``page_id``, ``record_type``, ``refers_to``, ``payload_digest``, ``url``, and the
    address of the payload."""
    h = F.col("header")
    r = spark.read.parquet(f"{path}/records")
    digest = F.regexp_replace(header_field(h, "WARC-Payload-Digest"), "^sha1:", "")
    return r.select(_id(header_field(h, "WARC-Record-ID")).alias("page_id"),
                    header_field(h, "WARC-Type").alias("record_type"),
                    _id(header_field(h, "WARC-Refers-To")).alias("refers_to"), digest.alias("payload_digest"),
                    header_field(h, "WARC-Target-URI").alias("url"), "header", "digest", "sha1", "length")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``record`` (the original record bytes: header, payload unless a revisit, closing lines),
    ``payload`` (of revisits as well, through the address) and ``verified``.  A payload that is missing or doesn't have
    its address is null, and so is the record of a response with one."""
    key = ["digest", "sha1", "length"]
    stored = read_payloads(spark, path).select(*key, "verified", F.when(F.col("verified"), F.col("payload")).alias("payload"))
    r = read_records(spark, path).join(stored, key, "left")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return r.select("page_id", F.concat("header", block, F.lit((CRLF * 2).encode())).alias("record"), "payload",
                    F.coalesce("verified", F.lit(False)).alias("verified"))


def archived(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of an archive, read back: ``page_id``, ``payload_bytes``, ``payload_digest`` (both computed
    from the stored payload that the address leads to), ``record_type``, ``refers_to``, ``verified``.  A record whose
    payload is missing or doesn't have its address, or another digest than the header says, isn't verified: its
    ``payload_bytes`` is null, its ``payload_digest`` the header's."""
    stored = read_payloads(spark, path).select(
        "digest", "sha1", "length", "verified", F.length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("_sha1"))
    r = read_records(spark, path).join(stored, ["digest", "sha1", "length"], "left")
    r = r.withColumn("verified", F.coalesce(F.col("verified") & (F.col("payload_digest") == F.col("_sha1")), F.lit(False)))
    return r.select("page_id", F.when(F.col("verified"), F.col("payload_bytes")).alias("payload_bytes"),
                    "payload_digest", "record_type", "refers_to", "verified")


def sql(pages: str = "pages", least_bytes: int = 0) -> str:
    """DuckDB SQL for the rows of ``archived``."""
    five = "CAST('0x' || substr(sha, i * 5 + 1, 5) AS BIGINT)"
    digit = lambda shift: f"substr('{BASE32}', CAST((({five} >> {shift}) & 31) + 1 AS BIGINT), 1)"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM {pages}),
q AS (SELECT page_id, strlen(body) AS payload_bytes, sha,
        array_to_string(list_transform(range(0, 8), lambda i: {digit(15)} || {digit(10)} || {digit(5)} || {digit(0)}),
                        '') AS payload_digest,
        CASE WHEN strlen(body) >= {least_bytes} AND count(*) OVER (PARTITION BY body) > 1
             THEN max(page_id) OVER (PARTITION BY body) END AS first_id
      FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM q
"""
