"""Explicit schemas: order events (two versions), landed records and the tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# The fields of an order event and their defaults.
ORDER_V1 = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("amountCents", T.LongType()),
    T.StructField("currency", T.StringType()),
    T.StructField("itemCount", T.IntegerType()),
    T.StructField("producedAt", T.LongType()),
    T.StructField("schemaVersion", T.StringType()),
])
ORDER_V2 = T.StructType([*ORDER_V1.fields, T.StructField("promoCode", T.StringType())])
REQUIRED_FIELDS = ("orderId", "customerId", "amountCents", "itemCount", "producedAt")
DEFAULT_CURRENCY = "USD"
DEFAULT_VERSION = "v2"

# Topics, partition counts, thresholds and holds.
ORDERS_TOPIC = "orders"
DLQ_TOPIC = "orders.dlq"
ORDERS_PARTITIONS = 12
DLQ_PARTITIONS = 3
LAG_ALERT_THRESHOLD = 5_000
P99_LIMIT_SECONDS = 2.0
MESSAGE_LIMIT = 2_000
COUNTER_TTL_HOURS = 2


_RECORD_TYPES = {"string": "string", "bigint": "long", "int": "int"}


def record_schema(version: str) -> str:
    """The record schema of an order event as registries keep it, with its defaults."""
    order = {"v1": ORDER_V1, "v2": ORDER_V2}[version]
    defaults = {"currency": DEFAULT_CURRENCY, "schemaVersion": version, "promoCode": None}
    fields = []
    for field in order:
        kind = _RECORD_TYPES[field.dataType.simpleString()]
        stated = {"name": field.name, "type": ["null", kind] if field.name == "promoCode" else kind}
        if field.name in defaults:
            stated["default"] = defaults[field.name]
        fields.append(stated)
    return json.dumps({"type": "record", "name": "OrderEvent", "fields": fields})


@dataclass(frozen=True)
class Rule:
    """An alert rule: its condition's limit, the range it looks back over, how long it must hold."""

    alert: str
    severity: str
    threshold: float
    hold_s: int
    range_s: int = 0
    step_s: int = 15


# The alert rules.
RULES = {
    "lag_high": Rule("ConsumerLagHigh", "warning", 5_000, 60),
    "lag_critical": Rule("ConsumerLagCritical", "critical", 50_000, 60),
    "dlq_growing": Rule("DlqGrowing", "warning", 0, 300, range_s=300),
    "p99_high": Rule("E2ELatencyP99High", "warning", P99_LIMIT_SECONDS, 300, range_s=300),
}

# One record as it lies in the landing folder (the columns a Kafka read gives, renamed).
LANDED = T.StructType([
    T.StructField("ingest_seq", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("record_partition", T.IntegerType()),
    T.StructField("record_offset", T.LongType()),
    T.StructField("record_key", T.StringType()),
    T.StructField("appended_at", T.TimestampNTZType()),
    T.StructField("payload", T.StringType()),
])

# One dead letter as its topic gives it: key, headers and bytes.
DEAD_LETTER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("dlq_partition", T.IntegerType()),
    T.StructField("record_key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("message", T.BinaryType()),
    T.StructField("trace", T.BinaryType()),
    T.StructField("origin", T.BinaryType()),
    T.StructField("received_at", T.TimestampNTZType()),
])

LEDGER = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("record_partition", T.IntegerType()),
    T.StructField("record_offset", T.LongType()),
    T.StructField("amount_cents", T.LongType()),
    T.StructField("produced_at", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])

INCREMENTS = T.StructType([
    T.StructField("minute", T.TimestampNTZType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("total_cents", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

QUARANTINE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("dlq_partition", T.IntegerType()),
    T.StructField("key_hint", T.StringType()),
    T.StructField("exception_message", T.StringType()),
    T.StructField("raw_base64", T.StringType()),
    T.StructField("received_at", T.TimestampNTZType()),
    T.StructField("batch_id", T.LongType()),
])

REPLAY_LOG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("replay_key", T.StringType()),
    T.StructField("replay_id", T.StringType()),
])

KIND_COUNTS = T.StructType([
    T.StructField("consumed", T.LongType()),
    T.StructField("orders", T.LongType()),
    T.StructField("poison", T.LongType()),
    T.StructField("tombstones", T.LongType()),
    T.StructField("unexpected", T.LongType()),
    T.StructField("counted_at", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

# Words of the ledger folders' key filters.
FILTERS = T.StructType([
    T.StructField("size_bits", T.IntegerType()),
    T.StructField("word", T.LongType()),
    T.StructField("bits", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

# Records that came after the horizon, and what became of them.
LATE = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("record_partition", T.IntegerType()),
    T.StructField("record_offset", T.LongType()),
    T.StructField("appended_at", T.TimestampNTZType()),
    T.StructField("copies", T.LongType()),
    T.StructField("applied", T.BooleanType()),
    T.StructField("batch_id", T.LongType()),
])

# First and last event time of a batch's records.
BATCH_TIMES = T.StructType([
    T.StructField("first_event", T.TimestampNTZType()),
    T.StructField("last_event", T.TimestampNTZType()),
    T.StructField("batch_id", T.LongType()),
])

COMMITS = T.StructType([
    T.StructField("committed_at", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

# One evaluation of an alert rule, and a stretch over which its condition held.
EVALUATIONS = T.StructType([
    T.StructField("alert", T.StringType()),
    T.StructField("eval_ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

STRETCHES = T.StructType([
    T.StructField("alert", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("since", T.TimestampType()),
    T.StructField("until", T.TimestampType()),
    T.StructField("ticks", T.LongType()),
    T.StructField("fired", T.BooleanType()),
])
