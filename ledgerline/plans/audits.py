"""Audits of what was applied against what was sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.payload import classify
from ledgerline.operators.arrival import first_copies, orders_of
from ledgerline.operators.keyfilter import filter_words
from ledgerline.operators.loss import find_loss
from ledgerline.operators.schemarules import (
    NO_DEFAULT,
    UNREADABLE,
    field_rules,
    schema_fields,
    shape_fields,
    verdicts,
    written_shapes,
)
from ledgerline.plans.orders import HALFWAY, decoded
from ledgerline.plans.registry import ORACLES, query
from ledgerline.plans.sqlparts import select
from ledgerline.schemas import record_schema
from ledgerline.session import fresh_folder, kept
from ledgerline.sources.feed import order_feed, with_offsets
from ledgerline.streaming.keyindex import unheld

LEDGER_DAYS = "datediff(appended_at, DATE '2024-01-01')"


def _dated_ledger(spark: SparkSession, orders: DataFrame) -> str:
    """The orders as a ledger with a folder a day, its key filters and commits; the folder it lies in."""
    root = fresh_folder(spark, "dated")
    first = first_copies(orders, ["appended_at"])
    rows = kept(first.select("order_id", F.expr(f"bigint({LEDGER_DAYS})").alias("batch_id")), "ledger")
    commits = rows.select("batch_id").distinct().withColumn("committed_at", F.lit(0).cast("long"))
    for table, frame in (("ledger", rows), ("filters", filter_words(rows)), ("commits", commits)):
        frame.write.partitionBy("batch_id").parquet(f"{root}/{table}")
    return root


@query("gate_indexed", ORACLES["first_sight_gate"])
def gate_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of ``first_sight_gate`` over a ledger in daily folders, of which few are scanned."""
    orders = kept(orders_of(decoded(spark, sf_dir)).select("ingest_seq", "order_id", "appended_at"), "orders")
    old = F.col("appended_at") < F.expr(f"TIMESTAMP_NTZ '{HALFWAY}'")
    root, batch = _dated_ledger(spark, orders.filter(old)), orders.filter(~old)
    applied = unheld(spark, root, first_copies(batch, []), 1 << 40).select("ingest_seq", F.lit(1).alias("applied"))
    judged = batch.select("ingest_seq", "order_id").join(applied, "ingest_seq", "left")
    return judged.withColumn("applied", F.coalesce("applied", F.lit(0)))


# The fixture's ledger lacks single orders and a stretch of one partition, and has foreign ones.
_GONE = "(ingest_seq % 1009 = 400 OR record_partition = 3 AND record_offset BETWEEN 20 AND 69)"
_FOREIGN = "ingest_seq % 499 = 77"


def _both_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First copies in the log, and a ledger with faults."""
    orders = orders_of(classify(with_offsets(order_feed(spark, sf_dir))))
    sent = kept(first_copies(orders, ["record_partition", "record_offset"]), "sent")
    name = F.expr(f"if({_FOREIGN}, concat('x-', order_id), order_id)")
    held = kept(sent.filter(f"NOT {_GONE}").withColumn("order_id", name), "held")
    return sent, held


@query("loss_ranges", select(f"""
    SELECT order_id, record_partition, record_offset, 'lost' AS verdict FROM firsts WHERE {_GONE} OR {_FOREIGN}
    UNION ALL
    SELECT 'x-' || order_id, record_partition, record_offset, 'unsent' FROM firsts
    WHERE {_FOREIGN} AND NOT {_GONE}""", "firsts"))
def loss_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that a ledger lost or never was sent, found through the ranges that differ."""
    return find_loss(*_both_sides(spark, sf_dir))[1]


@query("loss_digests", select(f"""
    SELECT record_partition, first_offset, first_offset + 64 AS past_offset, sent, held, about_missing FROM (
        SELECT record_partition, record_offset // 64 * 64 AS first_offset, count(*) AS sent,
               count(*) FILTER (NOT {_GONE}) AS held, count(*) FILTER ({_GONE} OR {_FOREIGN}) AS about_missing
        FROM firsts GROUP BY ALL)
    WHERE about_missing > 0""", "firsts"))
def loss_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of 64 offsets whose digests differ, and how many orders their sketches miss."""
    return find_loss(*_both_sides(spark, sf_dir))[0].drop("range")


_BROKEN_SQL = ", ".join(
    f"CASE WHEN json_type(doc, '$.{name}') IS NULL THEN '{name}: {NO_DEFAULT}' "
    f"WHEN json_type(doc, '$.{name}') NOT IN ({kinds}) THEN '{name}: {UNREADABLE}' END"
    for name, kinds in (
        ("amountCents", "'UBIGINT', 'BIGINT'"), ("customerId", "'VARCHAR'"), ("itemCount", "'UBIGINT', 'BIGINT'"),
        ("orderId", "'VARCHAR'"), ("producedAt", "'UBIGINT', 'BIGINT'"),
    ))


@query("schema_rules", select(f"""
    SELECT reader, fields, count(*) AS records, reasons = '' AS compatible, reasons FROM (
        SELECT unnest(['v1', 'v2']) AS reader, list_aggregate(list_sort(json_keys(doc)), 'string_agg', ',') AS fields,
               concat_ws(', ', {_BROKEN_SQL}) AS reasons
        FROM opened WHERE json_type(doc) = 'OBJECT')
    GROUP BY ALL""", "opened"))
def schema_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shape of record in the log against both versions of the reader's schema."""
    feed = order_feed(spark, sf_dir)
    shapes = kept(written_shapes(feed, "ingest_seq", "payload"), "shapes")
    examples = kept(feed.select("ingest_seq", "payload").join(shapes, "ingest_seq"), "examples")
    readers = spark.createDataFrame([(v, record_schema(v)) for v in ("v1", "v2")], "version string, text string")
    writer = kept(shape_fields(examples, "ingest_seq", "payload"), "fields")
    found = verdicts(field_rules(schema_fields(readers, "version", "text"), writer))
    names = writer.groupBy(F.col("schema").alias("writer")).agg(
        F.array_join(F.array_sort(F.collect_list("name")), ",").alias("fields")
    )
    counts = shapes.select(F.col("ingest_seq").alias("writer"), "records")
    return (
        found.join(names, "writer").join(counts, "writer")
        .groupBy("reader", "fields", "compatible", "reasons").agg(F.sum("records").alias("records"))
    )
