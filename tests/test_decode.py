"""Buckets, keys and tolerant decoding."""

from datetime import datetime

import pytest
from pyspark.sql import Row, functions as F

from ledgerline.functions import buckets
from ledgerline.functions.payload import (
    classify,
    envelope_ok,
    from_base64,
    magic_byte,
    schema_id,
    to_base64,
)
from ledgerline.operators.deadletter import from_headers, listing


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_minute_of_known_instant(spark):
    minute = buckets.minute_of(F.lit(1789903042500))
    assert one(spark, minute) == datetime(2026, 9, 20, 11, 17)


def test_minute_key_of_known_instant(spark):
    minute = buckets.minute_of(F.lit(1789903042500))
    assert one(spark, buckets.minute_key("p", minute)) == "p:20260920T1117"


def test_latency_is_never_negative(spark):
    assert one(spark, buckets.latency_millis(F.lit(10).cast("long"), F.lit(25).cast("long"))) == 0


def test_iso_instant_fraction_digits(spark):
    def text(ts):
        return one(spark, buckets.iso_instant(F.expr(f"TIMESTAMP_NTZ '{ts}'")))

    assert text("2024-01-01 00:00:01") == "2024-01-01T00:00:01Z"
    assert text("2024-01-01 00:00:01.250") == "2024-01-01T00:00:01.250Z"
    assert text("2024-01-01 00:00:01.250001") == "2024-01-01T00:00:01.250001Z"


FULL = (
    '{"orderId":"o-1","customerId":"c-1","amountCents":1000,"currency":"EUR","itemCount":1,'
    '"producedAt":5,"schemaVersion":"v2","promoCode":null}'
)
OLD = '{"orderId":"o-2","customerId":"c-1","amountCents":1,"itemCount":1,"producedAt":5,"schemaVersion":"v1"}'


def decode(spark, *payloads):
    rows = [Row(n=i, payload=p) for i, p in enumerate(payloads)]
    decoded = classify(spark.createDataFrame(rows, "n int, payload string"))
    return sorted(decoded.collect(), key=lambda r: r.n)


def test_kinds(spark):
    got = decode(
        spark, FULL, None, "", "THIS-IS-NOT-AVRO", '{"orderId":"o', '{"other":1}', "[1]", "   ",
        FULL.replace("1000", '"abc"'), FULL.replace('"orderId":"o-1",', ""), FULL.replace("1000", "1.5"),
    )
    assert [r.kind for r in got] == [
        "order", "tombstone", "poison", "poison", "poison", "unexpected", "poison", "poison",
        "poison", "poison", "poison",
    ]
    assert got[2].reason == "empty payload"
    assert got[3].reason == "malformed payload"
    assert got[9].reason == "missing required field: orderId"
    assert all(r.order_id is None for r in got[1:])


@pytest.mark.parametrize("text", [
    FULL + FULL, FULL + "XYZ", FULL + "," + FULL, FULL + "],[" + FULL, "[" + FULL + "]", FULL + "}", FULL + "]",
    FULL + ',"x":' + FULL, FULL + ',"r":' + FULL, "null", '"' + "o" + '"', "5", FULL + " 1", "," + FULL,
])
def test_a_payload_is_one_object(spark, text):
    row = decode(spark, text)[0]
    assert (row.kind, row.reason) == ("poison", "malformed payload")


def test_space_around_an_object_and_foreign_fields(spark):
    got = decode(spark, f"  {FULL}\n", FULL.replace("{", '{"extra":{"a":[1,{}]},', 1))
    assert [r.kind for r in got] == ["order", "order"]


def test_an_empty_id_is_no_id(spark):
    assert decode(spark, FULL.replace("o-1", ""))[0].reason == "missing required field: orderId"


def test_new_field_defaults_to_null(spark):
    row = decode(spark, FULL)[0]
    assert row.promo_code is None and row.currency == "EUR" and row.amount_cents == 1000


def test_old_record_reads_with_the_new_schema(spark):
    row = decode(spark, OLD)[0]
    assert (row.kind, row.promo_code, row.currency, row.schema_version) == ("order", None, "USD", "v1")


def test_base64_is_lossless_and_on_one_line(spark):
    text = to_base64(F.expr("encode(repeat('é\n', 300), 'UTF-8')"))
    encoded = one(spark, text)
    assert "\n" not in encoded and "\r" not in encoded
    assert one(spark, from_base64(F.lit(encoded)).cast("string")) == "é\n" * 300
    assert one(spark, to_base64(F.lit(None).cast("binary"))) == ""


def test_envelope(spark):
    wire = F.unhex(F.lit("0000000102AABB"))
    assert one(spark, magic_byte(wire)) == 0
    assert one(spark, schema_id(wire)) == 0x102
    assert one(spark, envelope_ok(wire, (0x102,))) is True
    assert one(spark, envelope_ok(wire, (1,))) is False
    assert one(spark, envelope_ok(F.unhex(F.lit("00")), (0,))) is False
    assert one(spark, envelope_ok(F.lit(None).cast("binary"), (0,))) is False


def test_header_fallbacks_and_cap(spark):
    rows = spark.createDataFrame(
        [(1, b"m" * 3000, b"t", b"orders"), (2, None, b"t", None), (3, None, None, None)],
        "n int, m binary, t binary, o binary",
    )
    got = {r.n: r for r in from_headers(rows, "m", "t", "o", "own").collect()}
    assert got[1].exception_message == "m" * 2000 and got[1].source_topic == "orders"
    assert got[2].exception_message == "t" and got[2].source_topic == "own"
    assert got[3].exception_message == "unknown"


def test_listing_hides_payload_and_null_key(spark):
    rows = spark.sql(
        "SELECT 1L id, 't' source_topic, 0 source_partition, 0L source_offset,"
        " string(null) key_hint, 'x' exception_message, 'AA' raw_base64, false replayed,"
        " TIMESTAMP_NTZ '2024-01-01 00:00:00' received_at"
    )
    row = listing(rows).first()
    assert row.key_hint == "" and "raw_base64" not in row.asDict()
