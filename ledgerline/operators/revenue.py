"""Revenue per minute, its totals, merges and the hot counters derived from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.buckets import minute_key, minute_of, usd
from ledgerline.schemas import COUNTER_TTL_HOURS


def per_minute(applied: DataFrame, *by: str) -> DataFrame:
    """Order count and cents per event-time minute (and ``by``).  Currency is not looked at."""
    return applied.groupBy(minute_of(F.col("produced_at")).alias("minute"), *by).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("amount_cents").alias("total_cents"),
    )


def merged(*parts: DataFrame) -> DataFrame:
    """Additive upsert: minutes present in several parts are summed."""
    columns = ["minute", "order_count", "total_cents"]
    rows = reduce(DataFrame.unionByName, [p.select(columns) for p in parts])
    return rows.groupBy("minute").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("total_cents").alias("total_cents"),
    )


def totals(minutes: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return minutes.agg(
        F.coalesce(F.sum("total_cents"), zero).alias("revenue_total_cents"),
        F.coalesce(F.sum("order_count"), zero).alias("revenue_order_count"),
    )


def revenue_panel(minutes: DataFrame) -> DataFrame:
    return minutes.select(
        "minute", "order_count", "total_cents", usd(F.col("total_cents")).alias("revenue_usd")
    ).orderBy("minute")


def orders_panel(minutes: DataFrame) -> DataFrame:
    return minutes.select("minute", F.col("order_count").alias("orders")).orderBy("minute")


def hot_counters(applied: DataFrame, as_of: Column, prefix: str = "revenue") -> DataFrame:
    """Total cents, order count and cents per minute key still alive at ``as_of``.

    A minute key lives two hours past its last write; the two totals never expire.  One
    pass over the orders: the totals are summed from the minutes.
    """
    minutes = applied.groupBy(minute_of(F.col("produced_at")).alias("minute")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("amount_cents").alias("total_cents"),
        F.max("committed_ms").alias("last_write"),
    )
    ttl = F.expr(f"INTERVAL {COUNTER_TTL_HOURS} HOURS")
    alive = F.timestamp_millis("last_write").cast("timestamp_ntz") + ttl > as_of
    key = (
        F.when(F.col("which") == "cents", F.lit(f"{prefix}:total_cents"))
        .when(F.col("which") == "orders", F.lit(f"{prefix}:order_count"))
        .otherwise(F.concat(minute_key(f"{prefix}:minute", F.col("minute")), F.lit(":cents")))
    )

    def entry(which: str, minute: Column, amount: str) -> Column:
        return F.struct(
            F.lit(which).alias("which"), minute.alias("minute"), F.col(amount).alias("n")
        )

    no_minute = F.lit(None).cast("timestamp_ntz")
    entries = F.array(
        entry("cents", no_minute, "total_cents"),
        entry("orders", no_minute, "order_count"),
        F.when(alive, entry("minute", F.col("minute"), "total_cents")),
    )
    return (
        minutes.select(F.inline(F.array_compact(entries)))
        .groupBy("which", "minute")
        .agg(F.sum("n").alias("value"))
        .select(key.alias("key"), "value")
    )
