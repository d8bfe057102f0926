"""Which batch folders of the ledger may hold a key, without reading their keys.

Every ledger folder has a key filter (see :mod:`ledgerline.operators.keyfilter`), written after the
folder and before the commit; a retry overwrites both.  A batch's keys are probed first and folders
without a hit are not scanned, so a gate's reads grow with its repeats, not with history.  A committed
folder without a filter counts as one that may hold any key.  Compaction makes one filter of many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.keyfilter import filter_words, possible
from ledgerline.session import kept
from ledgerline.streaming.outputs import compacted_base, last_compacted, read_batch, read_table, write_batch


def write_filter(spark: SparkSession, root: str, batch_id: int) -> None:
    """The filter of a ledger folder just written."""
    rows = read_batch(spark, root, "ledger", batch_id).select("order_id", F.lit(batch_id).cast("long").alias("batch_id"))
    write_batch(filter_words(rows).drop("batch_id"), root, "filters", batch_id)


def _earlier(spark: SparkSession, root: str, before: int) -> set[int]:
    """Committed batches before this one, the compacted ones as the last of them."""
    upto = last_compacted(spark, root, "orders")
    commits = read_table(spark, root, "commits").filter(F.col("batch_id") < before)
    ids = {r.batch_id for r in commits.select("batch_id").collect()}  # one row a batch
    return ids if upto is None else {max(i, upto) for i in ids}


def candidate_folders(
    spark: SparkSession, root: str, keys: DataFrame, before: int, recent: set[int] | None = None
) -> list[int]:
    """Earlier batches (of the recent ones, where given) whose folder may hold one of the keys."""
    folders = _earlier(spark, root, before)
    if recent is not None:
        upto = last_compacted(spark, root, "orders")
        folders &= recent if upto is None else {max(i, upto) for i in recent}
    filters = read_table(spark, root, "filters").filter(F.col("batch_id").isin(sorted(folders)))
    known = dict(filters.select("batch_id", "size_bits").distinct().collect())  # one row a folder
    hit = set()
    if known:
        passed = possible(keys, filters, set(known.values()))
        hit = {r.batch_id for r in passed.select("batch_id").distinct().collect()}
    return sorted(hit | (folders - known.keys()))


def keys_in(spark: SparkSession, root: str, folders: list[int]) -> DataFrame:
    """order_id of the given folders' rows; no other folder is scanned."""
    upto = last_compacted(spark, root, "orders")
    rows = spark.createDataFrame([], "order_id string")
    later = [i for i in folders if upto is None or i > upto]
    if later:
        plain = spark.read.schema("order_id string, batch_id long").parquet(f"{root}/ledger")
        rows = rows.union(plain.filter(F.col("batch_id").isin(later)).select("order_id"))
    if upto is not None and upto in folders:
        rows = rows.union(compacted_base(spark, root, "ledger", upto).select("order_id"))
    return rows


def unheld(
    spark: SparkSession, root: str, first: DataFrame, before: int, recent: set[int] | None = None
) -> DataFrame:
    """First copies whose order no earlier batch (no recent one, where given) has applied."""
    first = kept(first, "first")  # read by the probe and by the gate
    return first.join(keys_in(spark, root, candidate_folders(spark, root, first, before, recent)), "order_id", "left_anti")
