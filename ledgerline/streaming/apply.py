"""The order stream: every order applied once, whatever is delivered again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.payload import classify, intake_counts
from ledgerline.operators.arrival import first_copies, orders_of
from ledgerline.operators.deadletter import quarantine_rows, rows_of_topic
from ledgerline.schemas import DLQ_TOPIC, LATE, LEDGER, ORDERS_TOPIC
from ledgerline.session import kept
from ledgerline.streaming.keyindex import unheld, write_filter
from ledgerline.streaming.outputs import commit_increments, read_table, write_batch

_LEDGER_COLUMNS = [c for c in LEDGER.names if c != "batch_id"]
_LATE_COLUMNS = [c for c in LATE.names if c != "batch_id"]

BatchJob = Callable[[DataFrame, int], None]


def new_orders(records: DataFrame, topic: str = ORDERS_TOPIC) -> DataFrame:
    """Streaming: ledger rows of the orders first seen in each micro-batch.

    A streaming aggregate per order keeps the first copy as state, for ever.  Copies are
    combined before the shuffle, so a heavily resubmitted order costs one row per task,
    and state access grows with the batch, not with history.  A key is new when the batch
    that first saw it is the batch that last saw it; a batch keeps its time when it is run
    again.  All buffers are fixed-width.
    """
    seen = orders_of(classify(records, observe_as="intake")).withColumn(
        "batch_time", F.current_timestamp()
    )
    first = seen.groupBy("order_id").agg(
        *[
            F.min_by(c, "ingest_seq").alias(c)
            for c in ("record_partition", "record_offset", "amount_cents", "produced_at")
        ],
        F.min("batch_time").alias("processed_at"),
        F.max("batch_time").alias("last_seen"),
    )
    return (
        first.filter(F.col("processed_at") == F.col("last_seen"))
        .withColumn("topic", F.lit(topic))
        .select(*_LEDGER_COLUMNS)
    )


def recent_batches(spark: SparkSession, root: str, before: int, horizon: str) -> tuple[DataFrame, set[int]]:
    """The horizon's begin as a one-row frame (null at first), and the batches that may matter for what is after it.

    The begin lies ``horizon`` before the latest record of the earlier batches.  A copy after it
    repeats an order that came up to a horizon earlier still, so batches that end before that are out.
    """
    times = read_table(spark, root, "times").filter(F.col("batch_id") < before)
    begin = kept(times.agg((F.max("last_event") - F.expr(f"INTERVAL {horizon}")).alias("begin")), "horizon")
    since = begin.select((F.col("begin") - F.expr(f"INTERVAL {horizon}")).alias("since"))
    rows = times.select("batch_id", "last_event").join(since, F.col("last_event") >= F.col("since"))
    return begin, {r.batch_id for r in rows.select("batch_id").collect()}  # one row a batch


def bounded_job(spark: SparkSession, root: str, horizon: str) -> BatchJob:
    """A batch's first copies, checked against the batches within the horizon.

    For feeds whose redeliveries come within a known time: what is read for a batch doesn't grow with
    history, and a copy later than the horizon counts as a new order.  Records older than the horizon
    are late: their orders are looked up in the whole ledger, through the key filters, applied if
    nobody has, and listed in the table ``late`` either way.  Nothing is dropped.
    """

    def job(batch: DataFrame, batch_id: int) -> None:
        begin, recent = recent_batches(spark, root, batch_id, horizon)
        batch = kept(batch, "decoded")
        first = first_copies(
            orders_of(batch), ["record_partition", "record_offset", "amount_cents", "produced_at", "appended_at"]
        )
        early = F.coalesce(F.col("appended_at") < begin.select("begin").scalar(), F.lit(False))
        judged = kept(first.withColumn("early", early), "judged")
        on_time = unheld(spark, root, judged.filter("NOT early"), batch_id, recent)
        late = judged.filter("early")
        found = kept(unheld(spark, root, late, batch_id), "found")
        rows = on_time.unionByName(found).withColumns({
            "topic": F.lit(ORDERS_TOPIC), "processed_at": F.current_timestamp(),
        })
        write_batch(rows.select(*_LEDGER_COLUMNS), root, "ledger", batch_id)
        applied = found.select("order_id", F.lit(True).alias("applied"))
        listed = late.join(applied, "order_id", "left").withColumn("applied", F.coalesce("applied", F.lit(False)))
        write_batch(listed.select(*_LATE_COLUMNS), root, "late", batch_id)
        ends = batch.agg(F.min("appended_at").alias("first_event"), F.max("appended_at").alias("last_event"))
        write_batch(ends, root, "times", batch_id)
        write_filter(spark, root, batch_id)
        commit_increments(spark, root, batch_id)

    return job


def apply_bounded(
    spark: SparkSession, records: DataFrame, root: str, horizon: str = "1 day", drain: bool = True
) -> StreamingQuery:
    """Start the order stream whose look-back is bounded; late records are applied and listed."""
    decoded = classify(records, observe_as="intake")
    return start(decoded, bounded_job(spark, root, horizon), f"{root}/checkpoints/bounded", "append", drain)


def start(
    rows: DataFrame, job: BatchJob, checkpoint: str, mode: str, drain: bool = True
) -> StreamingQuery:
    """Run ``job`` on each micro-batch; ``drain`` stops once the input is used up."""
    writer = (
        rows.writeStream.foreachBatch(job)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def apply_job(spark: SparkSession, root: str) -> BatchJob:
    """Write a batch's new orders, then their increments and the commit stamp.

    Each state partition with new orders writes a file; ``compact`` rewrites them as few.
    """

    def job(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, root, "ledger", batch_id)
        commit_increments(spark, root, batch_id)

    return job


def apply_orders(
    spark: SparkSession, records: DataFrame, root: str, drain: bool = True
) -> StreamingQuery:
    """Start the order stream over ``records``, with its outputs below ``root``."""
    job = apply_job(spark, root)
    return start(new_orders(records), job, f"{root}/checkpoints/orders", "update", drain)


def quarantine_job(root: str) -> BatchJob:
    """Write a batch's dead letters and count its records by kind, in one pass."""

    def job(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = quarantine_rows(batch.observe(seen, *intake_counts()))
        write_batch(rows, root, "quarantine", batch_id)
        counts = batch.sparkSession.range(1).select(
            *[F.lit(n).cast("long").alias(name) for name, n in seen.get.items()],
            F.unix_millis(F.current_timestamp()).alias("counted_at"),
        )
        write_batch(counts, root, "counts", batch_id)

    return job


def quarantine_records(
    records: DataFrame, root: str, drain: bool = True
) -> StreamingQuery:
    """Start the quarantine stream: its own reader of the log, with its own progress."""
    decoded = classify(records, observe_as="intake")
    return start(decoded, quarantine_job(root), f"{root}/checkpoints/quarantine", "append", drain)


def quarantine_topic(dead_letters: DataFrame, root: str, drain: bool = True) -> StreamingQuery:
    """Start the stream that takes the dead-letter topic's records to quarantine rows."""

    def job(batch: DataFrame, batch_id: int) -> None:
        write_batch(rows_of_topic(batch, DLQ_TOPIC), root, "quarantine", batch_id)

    return start(dead_letters, job, f"{root}/checkpoints/dead-letters", "append", drain)


def gate_job(spark: SparkSession, root: str) -> BatchJob:
    """Stateless form: a batch's first copies, checked against the ledger.

    Of the ledger only the folders are read whose key filter one of the batch's keys passes.  Only
    earlier batches count as seen; the folder a crashed attempt left behind must not hide its own
    orders from the retry.
    """

    def job(batch: DataFrame, batch_id: int) -> None:
        first = first_copies(
            orders_of(batch),
            ["record_partition", "record_offset", "amount_cents", "produced_at"],
        )
        rows = unheld(spark, root, first, batch_id).withColumns({
            "topic": F.lit(ORDERS_TOPIC),
            "processed_at": F.current_timestamp(),
        })
        write_batch(rows.select(*_LEDGER_COLUMNS), root, "ledger", batch_id)
        write_filter(spark, root, batch_id)
        commit_increments(spark, root, batch_id)

    return job


def apply_backfill(
    spark: SparkSession, records: DataFrame, root: str, drain: bool = True
) -> StreamingQuery:
    """Start the stateless form: orders and dead letters in one query."""
    gate, quarantine = gate_job(spark, root), quarantine_job(root)

    def job(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # decoded once for both outputs
        try:
            quarantine(batch, batch_id)
            gate(batch, batch_id)
        finally:
            batch.unpersist()

    decoded = classify(records, observe_as="intake")
    return start(decoded, job, f"{root}/checkpoints/backfill", "append", drain)
