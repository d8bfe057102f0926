"""A content-addressed archive of WARC records.

Two tables: `payloads` holds the bytes of each payload once, under its SHA-256; `headers` holds
every record's header block byte for byte, with the digest of its payload.  Records are put
together again by a join on the digest.  Before payloads are stored, those with one digest are
compared byte for byte; when they are read, their bytes are hashed again.

Of records with equal payloads of at least 1000 bytes the one with the largest page_id is the
response; the others are revisits, whose record has no block and refers to the response.
Smaller payloads are all responses, stored once all the same.

All steps are DataFrame functions.  Equal payloads meet after a partial aggregation in each task,
and only digests and lengths are joined unless a reader asks for the bytes, so a payload that a
third of the pages share costs narrow rows.

Defined cases: a null html is an empty payload; a null url gives an empty target URI; line ends in
a url are taken out, for a header is one line; a null page_id is written as an empty id and refers
to nothing; repeated rows each have a record (with equal ids the revisit refers to that id); other
columns are not looked at; no rows give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import fresh_folder

LEAST_REVISIT = 1000
#: Fixed values of the format.
VERSION, END = "WARC/1.1", "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # the pages carry no time


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(END))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def header_block(page_id: Column, url: Column, digest: Column, size: Column, refers: Column) -> Column:
    """The record's header, up to and with the empty line; `refers` is null for a response."""
    revisit = refers.isNotNull()
    return F.concat(
        F.lit(VERSION + END),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(page_id)),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", "")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                _line("WARC-Refers-To", _record_id(refers)),
            ),
        ).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, 0).otherwise(size).cast("string")),
        F.lit(END),
    )


def write_archive(pages: DataFrame, folder: str) -> None:
    """Write the tables `payloads` and `headers` below the folder."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    full = pages.select("page_id", "url", payload.alias("payload"))
    keyed = full.withColumn("sha256", F.unhex(F.sha2("payload", 256)))
    keyed.select("sha256", "payload").distinct().write.option("compression", "zstd").parquet(f"{folder}/payloads")
    stored = pages.sparkSession.read.parquet(f"{folder}/payloads")
    if stored.groupBy("sha256").count().filter("count > 1").limit(1).count():
        raise ValueError("two different payloads have one SHA-256; the archive can't be trusted")

    listed = keyed.select(
        "page_id",
        "url",
        "sha256",
        F.sha1("payload").alias("digest"),
        F.octet_length("payload").cast("long").alias("size"),
        # rows that repeat a page_id: one of them is the response
        F.monotonically_increasing_id().alias("row"),
    )
    listed.write.parquet(f"{folder}/listed")
    listed = pages.sparkSession.read.parquet(f"{folder}/listed")
    last = F.max(F.struct("page_id", "row")).alias("last")
    owners = listed.filter(F.col("size") >= LEAST_REVISIT).groupBy("sha256").agg(last)
    joined = listed.join(owners, "sha256", "left")
    own = F.col("last").isNull() | (F.col("row") == F.col("last.row"))
    refers = F.when(~own, F.col("last.page_id"))
    header = header_block(F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"), refers)
    joined.select(header.alias("header"), "sha256").write.option("compression", "zstd").parquet(f"{folder}/headers")


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record put together again from its header and its payload.

    page_id, url, record_type, refers_to, payload_bytes, payload_digest, header, payload, record;
    size and digest are taken from the stored bytes, once for each payload.  `record` is the exact
    WARC record: the header, the block unless it is a revisit, two line ends.
    """
    stored = spark.read.parquet(f"{folder}/payloads")
    sound = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    payloads = stored.select(
        "sha256",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(sound, F.sha1("payload")).otherwise(F.raise_error(F.lit("a stored payload is damaged"))).alias("payload_digest"),
    )
    ident = lambda name: F.regexp_extract(_field(name), "<urn:page:(-?[0-9]*)>", 1)
    number = lambda name: F.when(ident(name) != "", ident(name)).cast("long")
    records = spark.read.parquet(f"{folder}/headers").select(
        "header",
        "sha256",
        number("WARC-Record-ID").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
    )
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.encode("header", "UTF-8"), block, F.lit((END + END).encode()))
    return records.join(payloads, "sha256").select(
        "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "header", "payload",
        record.alias("record"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP3_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS owner FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN owner END AS refers_to
FROM d
"""
