"""The order feed, derived from the ``events`` table.

Every tenth event resubmits an earlier order with another amount and time, and fixed
shares of the events are tombstones or one of eight kinds of poison, so each routing and
de-duplication rule has rows to act on.  Offsets have gaps, as a log of transactions has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.blocked import position
from ledgerline.schemas import DEFAULT_CURRENCY, ORDERS_PARTITIONS, ORDERS_TOPIC
from ledgerline.sources.tables import events

# Ids per block when offsets are numbered; it bounds the rows one task sorts together.
OFFSET_BLOCK = 1_000_000

# Records between two offsets that hold no record.
OFFSET_GAP = 100

COLUMNS = ("event_id", "ts", "user_id", "value")

# Which payload a record gets; the first rule that holds decides.
_SHAPE = """CASE WHEN ingest_seq % 100 = 51 THEN 'tombstone'
    WHEN ingest_seq % 100 = 13 THEN 'garbage'
    WHEN ingest_seq % 100 = 63 THEN 'truncated'
    WHEN ingest_seq % 200 = 91 THEN 'empty'
    WHEN ingest_seq % 200 = 29 THEN 'wrong type'
    WHEN ingest_seq % 200 = 129 THEN 'no id'
    WHEN ingest_seq % 400 = 171 THEN 'two objects'
    WHEN ingest_seq % 400 = 371 THEN 'trailing text'
    WHEN ingest_seq % 400 = 271 THEN 'blank id'
    ELSE 'order' END"""

# ``concat_ws`` leaves out the fields that are null.
_JSON = f"""concat('{{', concat_ws(',',
    if(shape <> 'no id', concat('"orderId":"', if(shape = 'blank id', '', order_key), '"'), null),
    concat('"customerId":"cust-', user_id, '"'),
    concat('"amountCents":', if(shape = 'wrong type', '"abc"', string(bigint(round(value * 100))))),
    if(ingest_seq % 20 <> 4, '"currency":"{DEFAULT_CURRENCY}"', null),
    concat('"itemCount":', 1 + ingest_seq % 5),
    concat('"producedAt":', unix_millis(timestamp(appended_at))),
    concat('"schemaVersion":"', version, '"'),
    if(version = 'v2' AND ingest_seq % 2 = 0, '"promoCode":"SAVE10"', null)), '}}')"""


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed for jobs that decode it; its pieces are those of the scan."""
    return feed_of(events(spark, sf_dir).select(*COLUMNS))


def feed_of(events: DataFrame) -> DataFrame:
    """One row per event, as a record without its offset (see :func:`with_offsets`)."""
    return (
        events.selectExpr(
            "event_id AS ingest_seq",
            "ts AS appended_at",
            "user_id",
            "value",
            "if(event_id % 10 = 7, event_id - 3, event_id) AS biz",
        )
        .selectExpr(
            "*",
            "concat('ord-', biz) AS order_key",
            "if(appended_at >= TIMESTAMP_NTZ '2024-01-16 00:00:00', 'v2', 'v1') AS version",
            f"{_SHAPE} AS shape",
        )
        .selectExpr(
            "ingest_seq",
            f"'{ORDERS_TOPIC}' AS topic",
            f"int(biz % {ORDERS_PARTITIONS}) AS record_partition",
            "if(ingest_seq % 200 <> 163, order_key, null) AS record_key",
            "appended_at",
            "bigint(round(value * 10)) AS latency_ms",
            f"""CASE shape WHEN 'tombstone' THEN null
                WHEN 'garbage' THEN 'THIS-IS-NOT-AVRO'
                WHEN 'truncated' THEN concat('{{"orderId":"', order_key)
                WHEN 'empty' THEN ''
                WHEN 'two objects' THEN repeat({_JSON}, 2)
                WHEN 'trailing text' THEN concat({_JSON}, 'XYZ')
                ELSE {_JSON} END AS payload""",
        )
    )


def with_offsets(feed: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """Add each record's offset: its position in its topic partition, by arrival, and the gaps.

    Only positions are numbered; the records themselves are joined to their numbers, those of
    :func:`offsets_of` where they are at hand.
    """
    numbers = offsets_of(feed) if offsets is None else offsets
    return feed.join(numbers.select("ingest_seq", "record_offset"), "ingest_seq")


def offsets_of(feed: DataFrame) -> DataFrame:
    """ingest_seq, record_partition and record_offset of every record."""
    blocks = feed.selectExpr(
        "ingest_seq", "record_partition", f"ingest_seq div {OFFSET_BLOCK} AS _block"
    )
    numbered = position(blocks, ["record_partition"], "_block", "ingest_seq", "_nth")
    return numbered.selectExpr(
        "ingest_seq", "record_partition", f"_nth + _nth div {OFFSET_GAP} AS record_offset"
    )
