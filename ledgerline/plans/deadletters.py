"""Quarantine, inspection lists and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.payload import FAILURE_PREFIX, POISON, classify
from ledgerline.operators.deadletter import (
    dlq_partition,
    from_headers,
    latest,
    light,
    listing,
    newest_first,
    pending,
    quarantine_rows,
    replay_records,
    with_replayed,
)
from ledgerline.plans.orders import decoded
from ledgerline.plans.registry import query
from ledgerline.plans.sqlparts import select
from ledgerline.schemas import DLQ_TOPIC
from ledgerline.session import kept
from ledgerline.sources.feed import offsets_of, order_feed

_ISO = """strftime(received_at, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN epoch_us(received_at) % 1000000 = 0 THEN ''
            WHEN epoch_us(received_at) % 1000 = 0 THEN strftime(received_at, '.%g')
            ELSE strftime(received_at, '.%f') END || 'Z'"""
_LISTING = f"""id, source_topic, source_partition, source_offset,
    coalesce(key_hint, '') AS key_hint, exception_message AS exception, replayed,
    {_ISO} AS received_at"""


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poison is picked out first: only its payloads are moved to their offsets."""
    feed = order_feed(spark, sf_dir)
    poison = classify(feed).filter(F.col("kind") == POISON)
    return quarantine_rows(poison.join(offsets_of(feed).drop("record_partition"), "ingest_seq"))


def stored_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine as a table, for the queries that look at it more than once."""
    return kept(quarantine(spark, sf_dir), "quarantine")


def replay_log(quarantine: DataFrame) -> DataFrame:
    """The fixture's log: half of the dead letters were sent again."""
    return quarantine.filter(F.col("id") % 400 < 200).select("id")


@query("dlq_quarantine", select("SELECT * EXCLUDE replayed FROM quarantine", "quarantine"))
def dlq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(spark, sf_dir)


def with_headers(poison: DataFrame) -> DataFrame:
    """Headers as a publisher leaves them: some messages are long, some headers missing."""
    seq = F.col("ingest_seq")
    padding = F.when(seq % 100 == 63, F.repeat(F.lit("x"), 2_100)).otherwise("")
    message = F.concat(F.lit(FAILURE_PREFIX), F.col("reason"), padding)
    trace = F.concat(F.lit("trace: "), F.col("reason"))
    return poison.withColumns({
        "message": F.when(seq % 3 != 0, F.encode(message, "UTF-8")),
        "trace": F.when(seq % 9 != 0, F.encode(trace, "UTF-8")),
        "origin": F.when(seq % 9 != 0, F.encode("topic", "UTF-8")),
    })


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead-letter topic's records."""
    feed = order_feed(spark, sf_dir)
    poison = classify(feed).filter(F.col("kind") == POISON)
    numbered = poison.join(offsets_of(feed).drop("record_partition"), "ingest_seq")
    return with_headers(numbered).select(
        F.col("ingest_seq").alias("id"),
        F.col("record_partition").alias("source_partition"),
        F.col("record_offset").alias("source_offset"),
        dlq_partition(F.col("record_partition")).alias("dlq_partition"),
        F.encode("record_key", "UTF-8").alias("record_key"),
        F.encode("payload", "UTF-8").alias("value"),
        "message",
        "trace",
        "origin",
        F.col("appended_at").alias("received_at"),
    )


@query("dlq_headers", select("""
    SELECT ingest_seq,
           left(coalesce(CASE WHEN ingest_seq % 3 <> 0
                         THEN 'Deserialization failed: ' || reason
                              || CASE WHEN ingest_seq % 100 = 63 THEN repeat('x', 2100) ELSE '' END END,
                         CASE WHEN ingest_seq % 9 <> 0 THEN 'trace: ' || reason END,
                         'unknown'), 2000) AS exception_message,
           CASE WHEN ingest_seq % 9 = 0 THEN 'orders.dlq' ELSE 'orders' END AS source_topic
    FROM decoded WHERE kind = 'poison'""", "decoded"))
def dlq_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = with_headers(decoded(spark, sf_dir).filter(F.col("kind") == POISON))
    return from_headers(published, "message", "trace", "origin", DLQ_TOPIC).select(
        "ingest_seq", "exception_message", "source_topic"
    )


@query("dlq_latest", select(f"""
    SELECT {_LISTING} FROM (SELECT * FROM quarantine ORDER BY received_at DESC, id DESC LIMIT 100)
    """, "quarantine"))
def dlq_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest are found by time and position; only these get offsets and texts."""
    feed = order_feed(spark, sf_dir)
    poison = classify(feed).filter(F.col("kind") == POISON)
    newest = kept(
        latest(poison.withColumnsRenamed({"ingest_seq": "id", "appended_at": "received_at"})), "newest"
    ).withColumnsRenamed({"id": "ingest_seq", "received_at": "appended_at"})
    stored = quarantine_rows(newest.join(offsets_of(feed).drop("record_partition"), "ingest_seq"))
    return listing(newest_first(with_replayed(stored, replay_log(newest.withColumnRenamed("ingest_seq", "id")))))


@query("dlq_pending", select(f"""
    SELECT {_LISTING} FROM quarantine WHERE NOT replayed""", "quarantine"))
def dlq_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_quarantine(spark, sf_dir)
    waiting = pending(stored, replay_log(stored))
    return listing(newest_first(waiting.withColumn("replayed", F.lit(False))))


@query("dlq_pending_count", select("""
    SELECT count(*) AS dlq_pending,
           CASE WHEN count(*) >= 1 THEN 'red' ELSE 'green' END AS light
    FROM quarantine WHERE NOT replayed""", "quarantine"))
def dlq_pending_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = decoded(spark, sf_dir).filter(F.col("kind") == POISON)
    ids = kept(dead.select(F.col("ingest_seq").alias("id")), "dead-ids")
    waiting = pending(ids, replay_log(ids))
    return waiting.agg(F.count(F.lit(1)).alias("dlq_pending")).withColumn(
        "light", light(F.col("dlq_pending"))
    )


@query("dlq_received_count", select(
    "SELECT count(*) AS dlq_received FROM quarantine", "quarantine"))
def dlq_received_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(spark, sf_dir).agg(F.count_if(F.col("kind") == POISON).alias("dlq_received"))


@query("dlq_replay", select("""
    SELECT id, 'orders' AS topic, 'replay-' || id AS key_prefix,
           decode(from_base64(raw_base64)) AS payload,
           count(*) OVER () AS replayed
    FROM quarantine WHERE NOT replayed""", "quarantine"))
def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replay sends; the random key suffix is left out of the comparison."""
    stored = stored_quarantine(spark, sf_dir)
    outgoing = kept(replay_records(pending(stored, replay_log(stored))), "outgoing")
    sent = outgoing.agg(F.count(F.lit(1)).alias("n")).scalar()
    return outgoing.select(
        "id",
        "topic",
        F.substring_index("replay_key", "-", 2).alias("key_prefix"),
        "payload",
        sent.alias("replayed"),
    )
