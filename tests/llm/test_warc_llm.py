import hashlib
import re

from compare import differences
from conftest import SF_DIR

from ledgerline.llm import warc
from ledgerline.llm.queries import ORACLES, QUERIES
from ledgerline.session import fresh_folder

PAGES = [
    (1, "http://a/1", "x" * 1000),
    (2, "http://a/2", "x" * 1000),
    (7, "http://a/7\r\nX: y", "x" * 1000),
    (3, "http://b/é?q=1", "é" * 600),
    (4, None, "short"),
    (5, "http://c", "short"),
    (6, "http://d", None),
    (8, "http://e", ""),
    (9, "http://f", "z" * 1500),
    (9, "http://f", "z" * 1500),
    (None, "http://g", "y" * 2000),
]


def archive(spark, rows, schema="page_id bigint, url string, html string, digest string, last string"):
    pages = spark.createDataFrame([(*r, "d", "l") for r in rows], schema)
    folder = fresh_folder(spark, "warc-test")
    warc.write_archive(pages, folder)
    return folder, warc.read_archive(spark, folder)


def parsed(record: bytes):
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block, end = rest[:-4], rest[-4:]
    assert version == "WARC/1.1" and end == b"\r\n\r\n" and len(block) == int(fields["Content-Length"])
    return fields, block


def test_matches_sql(spark):
    assert differences(QUERIES["op3_warc"](spark, SF_DIR), ORACLES["op3_warc"], SF_DIR) == ""


def test_odd_pages_round_trip(spark):
    folder, records = archive(spark, PAGES)
    got = records.collect()
    assert len(got) == len(PAGES)
    htmls = {i: h or "" for i, _, h in PAGES}
    urls = {i: re.sub("[\r\n]", "", u or "") for i, u, _ in PAGES}
    for r in got:
        payload = htmls[r.page_id].encode()
        fields, block = parsed(bytes(r.record))
        assert bytes(r.payload) == payload and r.payload_bytes == len(payload)
        assert r.payload_digest == hashlib.sha1(payload).hexdigest()
        assert fields["WARC-Payload-Digest"] == "sha1:" + r.payload_digest
        assert fields["WARC-Target-URI"] == r.url == urls[r.page_id]
        assert block == (payload if r.record_type == "response" else b"")
        assert fields["WARC-Type"] == r.record_type
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    revisits = [k for k in kinds if k[1] == "revisit"]
    assert revisits == [(1, "revisit", 7), (2, "revisit", 7), (9, "revisit", 9)]
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == stored.select("sha256").distinct().count() == 6


def test_no_pages(spark):
    assert archive(spark, [])[1].count() == 0
