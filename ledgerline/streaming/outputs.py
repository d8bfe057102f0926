"""Batch-keyed tables: the rule that makes a repeated micro-batch harmless.

Plain files have no MERGE, so nothing is updated in place.  Every table is a set of
``batch_id=N`` folders and a micro-batch overwrites its own folder, which a retry may do
any number of times.  Totals are sums over the folders.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.operators.keyfilter import filter_words
from ledgerline.operators.revenue import merged, per_minute
from ledgerline.schemas import (
    BATCH_TIMES,
    COMMITS,
    FILTERS,
    INCREMENTS,
    KIND_COUNTS,
    LATE,
    LEDGER,
    QUARANTINE,
    REPLAY_LOG,
)

SCHEMAS = {
    "ledger": LEDGER,
    "increments": INCREMENTS,
    "quarantine": QUARANTINE,
    "counts": KIND_COUNTS,
    "commits": COMMITS,
    "filters": FILTERS,
    "late": LATE,
    "times": BATCH_TIMES,
}


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Replace the table's folder of one micro-batch."""
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")


# The stream that numbers a table's batches.
STREAM_OF = {
    "ledger": "orders",
    "increments": "orders",
    "commits": "orders",
    "filters": "orders",
    "late": "orders",
    "times": "orders",
    "quarantine": "quarantine",
    "counts": "quarantine",
}


# The table that a batch of a stream writes last.
_LAST_WRITTEN = {"orders": "commits", "quarantine": "counts"}


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def last_compacted(spark: SparkSession, root: str, stream: str) -> int | None:
    """Last batch the newest finished compaction of a stream's tables covers."""
    log = _read(spark, f"{root}/compactions/{stream}", "done boolean, upto long")
    return log.agg(F.max("upto").alias("upto")).first().upto


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a table: the newest compaction and the batches after it."""
    batches = _read(spark, f"{root}/{table}", SCHEMAS[table])
    upto = last_compacted(spark, root, STREAM_OF[table])
    if upto is None:
        return batches
    base = compacted_base(spark, root, table, upto)
    return base.unionByName(batches.filter(F.col("batch_id") > upto))


def compacted_base(spark: SparkSession, root: str, table: str, upto: int) -> DataFrame:
    return _read(spark, f"{root}/compacted/{table}/{upto}", SCHEMAS[table])


def compact(spark: SparkSession, root: str, stream: str, upto: int) -> None:
    """Rewrite a stream's tables up to batch ``upto`` as few large files.

    ``upto`` must be a finished batch later than the last compaction's: what a batch writes
    after it was compacted would be lost, so anything else is refused.  Increments are
    summed on the way, and the ledger gets one key filter.  The files count only once the log entry is written, so readers
    never see half of a compaction; the batch folders it covers may be removed afterwards.
    """
    last = _read(spark, f"{root}/{_LAST_WRITTEN[stream]}", SCHEMAS[_LAST_WRITTEN[stream]])
    finished = last.filter(F.col("batch_id") == upto).limit(1).count()
    before = last_compacted(spark, root, stream)
    if not finished or (before is not None and upto <= before):
        raise ValueError(f"batch {upto} of {stream} isn't finished, or compacted already")
    for table in (t for t, owner in STREAM_OF.items() if owner == stream):
        rows = read_table(spark, root, table).filter(F.col("batch_id") <= upto)
        if table == "increments":
            rows = merged(rows).withColumn("batch_id", F.lit(upto).cast("long"))
        if table == "filters":
            ledger = read_table(spark, root, "ledger").filter(F.col("batch_id") <= upto)
            rows = filter_words(ledger.select("order_id", F.lit(upto).cast("long").alias("batch_id")))
        rows.select(*SCHEMAS[table].names).hint("rebalance").write.mode("overwrite").parquet(f"{root}/compacted/{table}/{upto}")
    done = spark.range(1).select(F.lit(True).alias("done"))
    done.write.mode("overwrite").parquet(f"{root}/compactions/{stream}/upto={upto}")


def read_batch(spark: SparkSession, root: str, table: str, batch_id: int) -> DataFrame:
    """One batch of a table, without the other folders being listed."""
    schema = T.StructType([f for f in SCHEMAS[table].fields if f.name != "batch_id"])
    return spark.read.schema(schema).parquet(f"{root}/{table}/batch_id={batch_id}")


def mark_written(spark: SparkSession, root: str, name: str) -> None:
    spark.range(1).write.mode("overwrite").parquet(f"{root}/written/{name}")


def is_written(spark: SparkSession, root: str, name: str) -> bool:
    """Was something marked as written in full?"""
    return _read(spark, f"{root}/written/{name}", "id long").count() > 0


def read_replay_log(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/replay_log", REPLAY_LOG)


def commit_increments(spark: SparkSession, root: str, batch_id: int) -> None:
    """Second half of a batch: increments from its ledger rows, then the commit stamp.

    The ledger rows are read back from storage, so the work before them is neither
    repeated nor kept in memory.  The stamp is taken after the increments are in place;
    a micro-batch's own clock stands still at its start.

    New orders are told by their batch's time, so it must lie past the last commit; a batch
    that began before it (the clock was set back) fails here, before its increments count.
    """
    applied = read_batch(spark, root, "ledger", batch_id)
    last = _read(spark, f"{root}/commits/batch_id={batch_id - 1}", "committed_at long").first()
    if last:
        early = F.unix_millis("processed_at") < last.committed_at
        refusal = F.raise_error(F.lit("the clock was set back: a batch began before the last commit"))
        applied = applied.withColumn(
            "produced_at", F.when(early, refusal.cast("long")).otherwise(F.col("produced_at"))
        )
    write_batch(per_minute(applied), root, "increments", batch_id)
    stamp = spark.range(1).select(
        F.unix_millis(F.current_timestamp()).alias("committed_at")
    )
    write_batch(stamp, root, "commits", batch_id)


def revenue_minutes(spark: SparkSession, root: str) -> DataFrame:
    """The revenue table: the sum of all increments."""
    return merged(read_table(spark, root, "increments"))


def committed_latency(spark: SparkSession, root: str) -> DataFrame:
    """Latency of every applied order: its batch's commit stamp minus its produce time."""
    ledger = read_table(spark, root, "ledger").select("order_id", "produced_at", "batch_id")
    return ledger.join(read_table(spark, root, "commits"), "batch_id").select(
        "order_id",
        F.greatest(F.lit(0).cast("long"), F.col("committed_at") - F.col("produced_at")).alias(
            "latency_ms"
        ),
    )
