"""Tolerant decoding: a bad record becomes data, never an exception."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.schemas import (
    DEFAULT_CURRENCY,
    DEFAULT_VERSION,
    MESSAGE_LIMIT,
    ORDER_V2,
    REQUIRED_FIELDS,
)

ORDER, POISON, TOMBSTONE, UNEXPECTED = "order", "poison", "tombstone", "unexpected"

EMPTY = "empty payload"
ENVELOPE = "bad envelope"
MALFORMED = "malformed payload"
MISSING = "missing required field: "
FAILURE_PREFIX = "Deserialization failed: "

_CORRUPT = "_corrupt"
_READ_SCHEMA = f"r {ORDER_V2.simpleString()}, {_CORRUPT} string"
_FOREIGN = " AND ".join(f"_event.{f.name} IS NULL" for f in ORDER_V2.fields)
_MISSING = f"WHEN _event.orderId = '' THEN '{MISSING}orderId' " + " ".join(
    f"WHEN _event.{field} IS NULL THEN '{MISSING}{field}'" for field in REQUIRED_FIELDS
)


def classify(
    records: DataFrame,
    payload: str = "payload",
    observe_as: str | None = None,
    refused: str | None = None,
) -> DataFrame:
    """Add ``kind``, ``reason`` and the order fields, read with the latest schema.

    Older records simply lack the newer fields: those come out null or defaulted.  A
    null payload is a tombstone, an object with none of the order fields is another
    record type, and whatever cannot be read as an order is poison with a reason.  An order
    without an id, missing or empty, has no identity to be applied once under: poison.

    A payload is one object and nothing else.  The parser stops after the first value, so the
    payload is read as the only field of an object and counted as the only element of an array:
    text behind it that one of the two would take breaks the other.

    ``refused`` names a column that is true for records whose envelope was refused (see
    :func:`classify_wire`): poison, whatever is inside.

    The intake counters are observed on the way, under ``observe_as``; two decoded inputs of
    one query need two names.  The observation is also a fence: a filter on ``kind`` pushed
    below it would repeat the JSON parse for every mention of a field, ten times the work
    of parsing once.
    """
    unfit = f"coalesce({refused}, false)" if refused else "false"
    options = f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{_CORRUPT}')"
    decoded = (
        records.selectExpr(
            "*",
            f"""from_json(concat('{{"r":', {payload}, '}}'), '{_READ_SCHEMA}', {options}) AS _read""",
            f"json_array_length(concat('[', {payload}, ']')) AS _values",
        )
        .selectExpr("* EXCEPT (_read)", "_read.r AS _event", f"_read.{_CORRUPT} AS {_CORRUPT}")
        .selectExpr(
            "*",
            f"""CASE WHEN {unfit} THEN '{ENVELOPE}'
                WHEN {payload} IS NULL THEN null
                WHEN {payload} = '' THEN '{EMPTY}'
                WHEN _event IS NULL OR {_CORRUPT} IS NOT NULL OR NOT _values <=> 1 THEN '{MALFORMED}'
                WHEN {_FOREIGN} THEN null
                {_MISSING} END AS reason""",
        )
        .selectExpr(
            "*",
            f"""CASE WHEN reason IS NOT NULL THEN '{POISON}'
                WHEN {payload} IS NULL THEN '{TOMBSTONE}'
                WHEN {_FOREIGN} THEN '{UNEXPECTED}'
                ELSE '{ORDER}' END AS kind""",
        )
        .selectExpr(
            f"* EXCEPT (_event, _values, {_CORRUPT})", f"if(kind = '{ORDER}', _event, null) AS _event"
        )
        .selectExpr(
            "* EXCEPT (_event)",
            "_event.orderId AS order_id",
            "_event.customerId AS customer_id",
            "_event.amountCents AS amount_cents",
            f"if(_event IS NULL, null, coalesce(_event.currency, '{DEFAULT_CURRENCY}')) AS currency",
            "_event.itemCount AS item_count",
            "_event.producedAt AS produced_at",
            f"if(_event IS NULL, null, coalesce(_event.schemaVersion, '{DEFAULT_VERSION}'))"
            " AS schema_version",
            "_event.promoCode AS promo_code",
            "if(_event IS NULL, null, _event.currency IS NULL) AS currency_defaulted",
        )
    )
    return decoded.observe(observe_as or f"intake-{uuid.uuid4().hex}", *intake_counts())


def classify_wire(
    records: DataFrame, wire: str, known_ids: tuple[int, ...], observe_as: str | None = None
) -> DataFrame:
    """``classify`` for records as they travel: magic byte, schema id, body.

    The envelope is checked first, the body behind a good one is decoded; a null record is a
    tombstone.
    """
    good = envelope_ok(F.col(wire), known_ids)
    opened = records.withColumns({
        "_refused": F.col(wire).isNotNull() & ~good,
        "payload": F.when(good, F.expr(f"substring({wire}, 6)").cast("string")),
    })
    return classify(opened, "payload", observe_as, "_refused").drop("_refused")


def intake_counts() -> list[Column]:
    """Records taken in, in total and by kind."""
    kind = F.col("kind")
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(kind == ORDER).alias("orders"),
        F.count_if(kind == POISON).alias("poison"),
        F.count_if(kind == TOMBSTONE).alias("tombstones"),
        F.count_if(kind == UNEXPECTED).alias("unexpected"),
    ]


def magic_byte(wire: Column) -> Column:
    """First byte of a binary envelope as a number; null when there is none."""
    return F.conv(F.hex(F.substring(wire, 1, 1)), 16, 10).cast("int")


def schema_id(wire: Column) -> Column:
    """Four-byte writer schema id behind the magic byte."""
    return F.conv(F.hex(F.substring(wire, 2, 4)), 16, 10).cast("long")


def envelope_ok(wire: Column, known_ids: tuple[int, ...]) -> Column:
    """Does the envelope carry the magic byte zero and a known schema id?"""
    return F.coalesce(
        (F.octet_length(wire) >= 5)
        & (magic_byte(wire) == 0)
        & schema_id(wire).isin(*known_ids),
        F.lit(False),
    )


def to_base64(raw: Column) -> Column:
    """Base64 text on one line; a null payload gives an empty text."""
    return F.coalesce(F.translate(F.base64(raw), "\r\n", ""), F.lit(""))


def from_base64(text: Column) -> Column:
    return F.unbase64(text)


def capped_message(message: Column) -> Column:
    """Error text as stored: at most 2,000 characters, ``unknown`` when there is none."""
    return F.coalesce(F.left(message, F.lit(MESSAGE_LIMIT)), F.lit("unknown"))


def header_text(first: Column, second: Column) -> Column:
    """UTF-8 text of the first header that is present."""
    return F.coalesce(F.decode(first, "UTF-8"), F.decode(second, "UTF-8"))
