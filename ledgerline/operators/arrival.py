"""First copy per business key, and the gate against orders already applied.

A resubmitted order can make up a large share of a feed, so copies are combined on the
map side by an aggregate and never gathered in a window: each task sends at most one row
per order.  With fixed-width columns the aggregate stays a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.payload import ORDER


def orders_of(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("kind") == ORDER)


def first_copies(
    orders: DataFrame, columns: list[str], key: str = "order_id", order: str = "ingest_seq"
) -> DataFrame:
    """The earliest copy's ``columns`` for each key, and how many copies there were.

    ``order`` must be unique within a key, as a log position is.
    """
    return orders.groupBy(key).agg(
        F.min(order).alias(order),
        F.count(F.lit(1)).alias("copies"),
        *[F.min_by(c, order).alias(c) for c in columns],
    )


def unseen(first: DataFrame, ledger: DataFrame, key: str = "order_id") -> DataFrame:
    """First copies whose key the ledger does not hold.  Both sides have unique keys."""
    return first.join(ledger.select(key), key, "left_anti")


def split_gate(orders: DataFrame, in_ledger: Column) -> DataFrame:
    """The gate where ledger and batch are parts of one log, told apart by a condition.

    One aggregate per order finds the first copy in the batch and whether the ledger has one.
    """
    rows = orders.withColumn("_old", in_ledger)
    fresh = F.when(~F.col("_old"), F.col("ingest_seq"))
    applied = (
        rows.groupBy("order_id")
        .agg(F.min(fresh).alias("ingest_seq"), F.count_if("_old").alias("_held"))
        .filter("_held = 0")
        .select("ingest_seq", F.lit(1).alias("applied"))
    )
    batch = rows.filter(~F.col("_old")).select("ingest_seq", "order_id")
    return batch.join(applied, "ingest_seq", "left").withColumn(
        "applied", F.coalesce("applied", F.lit(0))
    )


def gate_results(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """1 for each record that is applied, 0 for each that is a repeat.

    The verdict is joined back on the record's own position, which is unique, so a
    heavily repeated order does not land in one task.
    """
    applied = unseen(first_copies(orders, []), ledger).select(
        "ingest_seq", F.lit(1).alias("applied")
    )
    return orders.join(applied, "ingest_seq", "left").withColumn(
        "applied", F.coalesce("applied", F.lit(0))
    )
