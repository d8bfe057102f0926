"""Dead letters: quarantine rows, inspection lists, replay bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.buckets import iso_instant
from ledgerline.functions.payload import (
    FAILURE_PREFIX,
    POISON,
    capped_message,
    from_base64,
    header_text,
    to_base64,
)
from ledgerline.schemas import DLQ_PARTITIONS, ORDERS_TOPIC


def dlq_partition(source_partition: Column, partitions: int = DLQ_PARTITIONS) -> Column:
    return F.abs(source_partition % partitions)


def quarantine_rows(decoded: DataFrame) -> DataFrame:
    """One row per poison record, with its original coordinates and exact bytes.

    The identity is the record's log position, so writing a batch again gives the same
    rows.
    """
    return decoded.filter(F.col("kind") == POISON).select(
        F.col("ingest_seq").alias("id"),
        F.col("topic").alias("source_topic"),
        F.col("record_partition").alias("source_partition"),
        F.col("record_offset").alias("source_offset"),
        dlq_partition(F.col("record_partition")).alias("dlq_partition"),
        F.col("record_key").alias("key_hint"),
        capped_message(F.concat(F.lit(FAILURE_PREFIX), F.col("reason"))).alias("exception_message"),
        to_base64(F.col("payload").cast("binary")).alias("raw_base64"),
        F.col("appended_at").alias("received_at"),
    )


def from_headers(
    records: DataFrame, message: str, trace: str, original_topic: str, own_topic: str
) -> DataFrame:
    """Error text and source topic of a dead letter, each with its fallbacks."""
    return records.withColumns({
        "exception_message": capped_message(header_text(F.col(message), F.col(trace))),
        "source_topic": F.coalesce(F.decode(F.col(original_topic), "UTF-8"), F.lit(own_topic)),
    })


def rows_of_topic(dead_letters: DataFrame, own_topic: str) -> DataFrame:
    """Quarantine rows of records as the dead-letter topic gives them."""
    return from_headers(dead_letters, "message", "trace", "origin", own_topic).select(
        "id",
        "source_topic",
        "source_partition",
        "source_offset",
        "dlq_partition",
        F.decode("record_key", "UTF-8").alias("key_hint"),
        "exception_message",
        to_base64(F.col("value")).alias("raw_base64"),
        "received_at",
    )


def with_replayed(quarantine: DataFrame, replay_log: DataFrame) -> DataFrame:
    """Add ``replayed``: has the log an entry for the row?"""
    sent = replay_log.select("id").distinct().withColumn("replayed", F.lit(True))
    return quarantine.join(sent, "id", "left").withColumn(
        "replayed", F.coalesce("replayed", F.lit(False))
    )


def pending(quarantine: DataFrame, replay_log: DataFrame) -> DataFrame:
    return quarantine.join(replay_log.select("id"), "id", "left_anti")


def listing(quarantine: DataFrame) -> DataFrame:
    """The inspection columns; the raw payload stays out."""
    return quarantine.select(
        "id",
        "source_topic",
        "source_partition",
        "source_offset",
        F.coalesce("key_hint", F.lit("")).alias("key_hint"),
        F.col("exception_message").alias("exception"),
        "replayed",
        iso_instant(F.col("received_at")).alias("received_at"),
    )


def latest(quarantine: DataFrame, n: int = 100) -> DataFrame:
    """The newest dead letters; ties are broken by id."""
    return quarantine.orderBy(F.desc("received_at"), F.desc("id")).limit(n)


def newest_first(quarantine: DataFrame) -> DataFrame:
    return quarantine.orderBy(F.desc("received_at"), F.desc("id"))


def light(value: Column) -> Column:
    """Panel colour: any dead letter or alert is red."""
    return F.when(value >= 1, "red").otherwise("green")


def replay_records(waiting: DataFrame) -> DataFrame:
    """Original bytes under a fresh key, so a replay can be told apart in the log."""
    return waiting.select(
        "id",
        F.lit(ORDERS_TOPIC).alias("topic"),
        F.concat(F.lit("replay-"), F.col("id").cast("string"), F.lit("-"), F.expr("uuid()")).alias(
            "replay_key"
        ),
        from_base64(F.col("raw_base64")).cast("string").alias("payload"),
    )
