"""Metric samples from the running streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.payload import ORDER, POISON, classify
from ledgerline.operators.blocked import running
from ledgerline.operators.lag import lag_of
from ledgerline.operators.reconcile import one_row
from ledgerline.operators.series import DAY
from ledgerline.schemas import LANDED
from ledgerline.streaming.outputs import read_table


def counter_samples(spark: SparkSession, root: str) -> DataFrame:
    """Counters as samples (name, t in seconds, v), one per micro-batch.

    The batches' counts are run up in batch order; a batch that was run again has only
    its last count.
    """
    counts = read_table(spark, root, "counts").withColumn(
        "day", F.expr(f"counted_at div {DAY * 1000}")
    )
    totals = running(
        counts,
        [],
        "day",
        "batch_id",
        sums={"orders_consumed": F.col("consumed"), "dlq_received": F.col("poison")},
    )
    return totals.withColumn("t", F.expr("counted_at div 1000")).unpivot(
        "t", ["orders_consumed", "dlq_received"], "name", "v"
    )


def held_against_log(spark: SparkSession, root: str, landing: str) -> DataFrame:
    """Per order and dead letter how often it was landed and how often an output holds it.

    The log is decoded anew, so nothing here rests on what the stream counted.  Copies are added up
    before they meet the outputs.
    """
    landed = classify(spark.read.schema(LANDED).parquet(landing)).filter(F.col("kind").isin(ORDER, POISON))
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    sent = landed.select(
        "kind", F.coalesce("order_id", F.col("ingest_seq").cast("string")).alias("key"), one.alias("sent"), none.alias("held")
    )
    applied = read_table(spark, root, "ledger").select(F.lit(ORDER), "order_id", none, one)
    dead = read_table(spark, root, "quarantine").select(F.lit(POISON), F.col("id").cast("string"), none, one)
    return sent.union(applied).union(dead).groupBy("kind", "key").agg(
        F.sum("sent").alias("sent"), F.sum("held").alias("held")
    )


def missing_rows(spark: SparkSession, root: str, landing: str) -> DataFrame:
    """kind and key of the orders nobody applied and the dead letters nobody kept."""
    return held_against_log(spark, root, landing).filter("sent > 0 AND held = 0").select("kind", "key")


def stream_balance(spark: SparkSession, root: str, landing: str) -> DataFrame:
    """What was landed against what the stream counted, applied and quarantined, in one row.

    ``lost`` records were landed and not taken in, by the intake counts.  ``missing`` are the
    orders and dead letters of the decoded log that no output holds; ``unknown`` ones an output
    holds and the log doesn't, ``repeated`` ones it holds more than once.  ``duplicates`` are the
    log's further copies of its orders.
    """
    produced = spark.read.parquet(landing).agg(F.count(F.lit(1)).alias("produced"))
    counts = read_table(spark, root, "counts")
    taken = counts.agg(*[
        F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c)
        for c in ("consumed", "orders", "poison", "tombstones", "unexpected")
    ])
    zero, is_order = F.lit(0).cast("long"), F.col("kind") == ORDER
    meeting = held_against_log(spark, root, landing).agg(
        F.coalesce(F.sum(F.when(is_order, F.col("held"))), zero).alias("unique_orders"),
        F.coalesce(F.sum(F.when(~is_order, F.col("held"))), zero).alias("quarantined"),
        F.coalesce(F.sum(F.when(is_order & (F.col("sent") > 0), F.col("sent") - 1)), zero).alias("duplicates"),
        F.count_if((F.col("sent") > 0) & (F.col("held") == 0)).alias("missing"),
        F.count_if(F.col("sent") == 0).alias("unknown"),
        F.count_if(F.col("held") > 1).alias("repeated"),
    )
    row = one_row(produced, taken, meeting).withColumn("lost", F.col("produced") - F.col("consumed"))
    return row.withColumn(
        "balanced",
        F.expr("lost = 0 AND missing = 0 AND unknown = 0 AND repeated = 0"
               " AND consumed = orders + poison + tombstones + unexpected"),
    ).select(
        "produced", "consumed", "unique_orders", "duplicates", "quarantined", "tombstones",
        "unexpected", "lost", "missing", "unknown", "repeated", "balanced",
    )


def lag_from_progress(spark: SparkSession, progress: str) -> DataFrame:
    """Lag per partition from a Kafka stream's progress report (JSON text).

    Processed offsets stand against the latest ones the source has seen; the report has
    one entry per partition.
    """
    rows = []
    for source in json.loads(progress)["sources"]:
        done, latest = source.get("endOffset") or {}, source.get("latestOffset") or {}
        for topic, ends in latest.items():
            for partition, end in ends.items():
                rows.append((topic, int(partition), end, done.get(topic, {}).get(partition)))
    schema = "topic string, record_partition int, end_offset long, committed_offset long"
    return spark.createDataFrame(rows, schema).withColumn(
        "lag", lag_of(F.col("end_offset"), F.col("committed_offset"))
    )
