"""Counters, zero-loss reconciliation and the throughput report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.payload import ORDER, POISON, TOMBSTONE, UNEXPECTED


def copies_by_key(decoded: DataFrame) -> DataFrame:
    """Copies per (kind, order).

    The records that are no orders share one row per kind, built on the map side.
    """
    return decoded.groupBy("kind", "order_id").agg(F.count(F.lit(1)).alias("n"))


def identity(copies: DataFrame) -> DataFrame:
    """records = unique + duplicate + poison + tombstone + unexpected, in one row."""
    zero = F.lit(0).cast("long")
    is_order = F.col("kind") == ORDER

    def of(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), zero)

    return copies.agg(
        F.coalesce(F.sum("n"), zero).alias("records"),
        F.count_if(is_order).alias("unique_orders"),
        (of(ORDER) - F.count_if(is_order)).alias("duplicates"),
        of(POISON).alias("poison"),
        of(TOMBSTONE).alias("tombstones"),
        of(UNEXPECTED).alias("unexpected"),
    ).transform(balanced)


def balanced(row: DataFrame) -> DataFrame:
    """Do the kinds add up to ``records``, which should be counted elsewhere?"""
    total = "records = unique_orders + duplicates + poison + tombstones + unexpected"
    return row.withColumn("balanced", F.expr(total))


def order_differences(produced: DataFrame, applied: DataFrame) -> DataFrame:
    """Orders produced but not applied once, or applied without being produced.

    Both sides are counted per order before they meet.
    """
    sent = produced.groupBy("order_id").agg(F.count(F.lit(1)).alias("produced"))
    done = applied.groupBy("order_id").agg(F.count(F.lit(1)).alias("applied"))
    return not_applied_once(
        sent.join(done, "order_id", "full").select(
            "order_id",
            F.coalesce("produced", F.lit(0)).alias("produced"),
            F.coalesce("applied", F.lit(0)).alias("applied"),
        )
    )


def not_applied_once(counts: DataFrame) -> DataFrame:
    """Of orders with both counts, those that weren't produced or weren't applied exactly once."""
    return counts.filter((F.col("produced") == 0) | (F.col("applied") != 1))


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row results side by side: stacked with nulls, then folded into one row."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
