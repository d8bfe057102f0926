"""Alert stretches as session windows of a stream of rule evaluations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.schemas import EVALUATIONS, STRETCHES, Rule

DELAY = "1 minute"  # how late an evaluation may come


def closed_stretches(evaluations: DataFrame, rule: Rule, delay: str = DELAY) -> DataFrame:
    """Stretches over which a rule's condition held, once they are over.

    A stretch is a session of true evaluations whose gap is more than one step and less than two,
    so a false, null or missing tick ends it.  False evaluations move the watermark on, which is
    what closes a stretch; the state holds open stretches only.  A tick given twice counts once.
    """
    # The condition names the event time so that it stays behind the watermark.
    over = F.when(F.col("eval_ts").isNotNull(), F.col("value") > rule.threshold)
    gap = f"{rule.step_s * 1500} milliseconds"
    sessions = (
        evaluations.filter(F.col("alert").isNotNull())
        .withWatermark("eval_ts", delay)
        .filter(over)
        .groupBy("alert", F.session_window("eval_ts", gap))
        .agg(F.min("eval_ts").alias("since"), F.max("eval_ts").alias("until"))
    )
    held = F.unix_seconds("until") - F.unix_seconds("since")
    return sessions.select(
        "alert", F.lit(rule.severity).alias("severity"), "since", "until",
        (F.floor(held / rule.step_s) + 1).cast("long").alias("ticks"),
        (held >= rule.hold_s).alias("fired"),
    )


def watch(spark: SparkSession, path: str, root: str, rule: Rule, delay: str = DELAY) -> StreamingQuery:
    """Follow a folder of evaluations until it is drained; closed stretches go to ``root``."""
    rows = spark.readStream.schema(EVALUATIONS).parquet(path)
    return (
        closed_stretches(rows, rule, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoints/stretches")
        .trigger(availableNow=True)
        .start(f"{root}/stretches")
    )


def read_stretches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STRETCHES).parquet(f"{root}/stretches")
