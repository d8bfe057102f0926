"""Sending dead letters round again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.operators.deadletter import pending, replay_records
from ledgerline.schemas import LANDED, ORDERS_PARTITIONS
from ledgerline.sources.landing import files_for
from ledgerline.streaming.outputs import is_written, mark_written, read_replay_log, read_table


def waiting(spark: SparkSession, root: str) -> DataFrame:
    """Dead letters not sent again yet."""
    return pending(read_table(spark, root, "quarantine"), read_replay_log(spark, root))


def replay_all(
    spark: SparkSession,
    root: str,
    landing: str,
    replay_id: str,
    seq_base: int,
    repair: Column | None = None,
) -> int:
    """Send every waiting dead letter to the log under a new key; how many there were.

    The call may be repeated under its id until it returns: every step is done once.  The rows
    to send are written first, with their keys, and everything after reads them back; a second
    call takes those rows again and not what waits by then.  Rows that lie in the log already
    are left out of the append, and the mark comes last.  The append is as few files as hold it: a stream
    may take each for a micro-batch of its own.  ``repair`` may give another payload.
    ``seq_base`` must lie past every position in the log.
    """
    logged = read_replay_log(spark, root).filter(F.col("replay_id") == replay_id)
    done = logged.count()
    if done:
        return done
    schema = "id long, topic string, replay_key string, payload string"
    outgoing = f"{root}/outgoing/{replay_id}"
    if not is_written(spark, root, f"outgoing-{replay_id}"):
        rows = replay_records(waiting(spark, root))
        if repair is not None:
            rows = rows.withColumn("payload", repair)
        rows.write.mode("overwrite").parquet(outgoing)
        mark_written(spark, root, f"outgoing-{replay_id}")
    sent = spark.read.schema(schema).parquet(outgoing)
    target = F.pmod(F.xxhash64("replay_key"), F.lit(ORDERS_PARTITIONS)).cast("int")
    landed = (
        spark.read.schema(LANDED).parquet(landing)
        .filter(F.col("ingest_seq") >= seq_base)
        .select(F.col("record_key").alias("replay_key"))
    )
    sent.join(landed, "replay_key", "left_anti").select(
        (F.col("id") + seq_base).alias("ingest_seq"),
        "topic",
        target.alias("record_partition"),
        (F.col("id") + seq_base).alias("record_offset"),
        F.col("replay_key").alias("record_key"),
        F.current_timestamp().cast("timestamp_ntz").alias("appended_at"),
        "payload",
    ).select(*LANDED.names).repartition(files_for(sent.count())).write.mode("append").parquet(landing)
    sent.select("id", "replay_key").write.mode("overwrite").parquet(
        f"{root}/replay_log/replay_id={replay_id}"
    )
    return sent.count()
