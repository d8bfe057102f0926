"""Metric samples on a grid, hourly or as fine as asked for, derived from the ``events`` table.

Long form: ``name, series, le, t, v`` with ``t`` in whole seconds.  Each counter is
counted per (series, tick) first; only those counts are then run up along the grid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.functions.buckets import epoch_seconds
from ledgerline.functions.payload import POISON, classify
from ledgerline.operators.arrival import first_copies, orders_of
from ledgerline.operators.blocked import running
from ledgerline.operators.lag import lag_of
from ledgerline.operators.latency import BOUNDS
from ledgerline.operators.series import DAY, day_of
from ledgerline.schemas import ORDERS_PARTITIONS
from ledgerline.session import kept
from ledgerline.sources.feed import feed_of, order_feed
from ledgerline.sources.tables import events

STEP = 3_600

# Fixed times of the fixture, in epoch seconds (UTC).
RESTART = 1_705_276_800  # 2024-01-15 00:00, the consumed counter starts again
FREEZE_FROM = 1_704_844_800  # 2024-01-10 00:00, commits stand still
FREEZE_TO = 1_705_017_600  # 2024-01-12 00:00
QUIET_FROM = 1_705_708_800  # 2024-01-20 00:00, the producer holds its records back
QUIET_TO = 1_705_726_800  # 2024-01-20 05:00
COMMIT_DELAY = 6 * STEP
INSTANCES = 3


def tick_of(ntz: str, step_s: int = STEP) -> Column:
    """First tick at or after a time."""
    step = step_s * 1_000_000
    return F.expr(f"(unix_micros(cast({ntz} as timestamp)) + {step - 1}) div {step} * {step_s}")


def ticks(spark: SparkSession, sf_dir: str, step_s: int = STEP) -> DataFrame:
    """The grid: from the first tick that has a record at or before it to the last."""
    span = events(spark, sf_dir).agg(
        tick_of("min(ts)", step_s).alias("lo"), epoch_seconds(F.max("ts")).alias("hi")
    )
    days = span.select("lo", "hi", F.explode(F.sequence(day_of("lo"), day_of("hi"))).alias("day"))
    first = F.col("day") * DAY
    steps = F.sequence(first, first + DAY - step_s, F.lit(step_s).cast("long"))
    return (
        days.select("lo", "hi", "day", F.explode(steps).alias("t"))
        .filter((F.col("t") >= F.col("lo")) & (F.col("t") <= F.col("hi")))
        .select("day", "t")
    )


def _counter(grid: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Run per-tick counts up along the grid.

    The counts per tick are written first: they are few, and everything built on the
    samples would otherwise scan the events again for each mention.
    """
    filled = grid.join(counts, [*keys, "t"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return running(kept(filled, "ticks"), keys, "day", "t", sums={"v": F.col("n")}).drop("n")


def _per_series(grid: DataFrame, name: str, size: int) -> DataFrame:
    return grid.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))


def consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumed records per series; starts from zero again after the restart."""
    counts = (
        events(spark, sf_dir)
        .select(
            (F.col("event_id") % ORDERS_PARTITIONS).cast("int").alias("series"),
            (epoch_seconds(F.col("ts")) >= RESTART).alias("restarted"),
            tick_of("ts").alias("t"),
        )
        .groupBy("series", "restarted", "t")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = _per_series(ticks(spark, sf_dir), "series", ORDERS_PARTITIONS).withColumn(
        "restarted", F.col("t") >= RESTART
    )
    return _counter(grid, counts, ["series", "restarted"]).select("series", "t", "v")


def dead_letters(spark: SparkSession, sf_dir: str, step_s: int = STEP) -> DataFrame:
    """Records quarantined so far."""
    counts = (
        classify(order_feed(spark, sf_dir))
        .filter(F.col("kind") == POISON)
        .groupBy(tick_of("appended_at", step_s).alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _counter(ticks(spark, sf_dir, step_s), counts, []).select("t", "v")


def latency_buckets(spark: SparkSession, sf_dir: str, step_s: int = STEP) -> DataFrame:
    """Cumulative latency buckets per service instance, over the orders at first sight."""
    bounds = [*BOUNDS, float("inf")]
    orders = orders_of(classify(order_feed(spark, sf_dir)))
    rows = first_copies(orders, ["appended_at", "latency_ms"]).select(
        (F.col("ingest_seq") % INSTANCES).cast("int").alias("series"),
        tick_of("appended_at", step_s).alias("t"),
        (F.col("latency_ms") / 1000.0).alias("seconds"),
    )
    wide = rows.groupBy("series", "t").agg(
        *[F.count_if(F.col("seconds") <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    )
    counts = wide.select(
        "series",
        "t",
        F.inline(F.array(*[
            F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)
        ])),
    )
    grid = _per_series(ticks(spark, sf_dir, step_s), "series", INSTANCES).withColumn(
        "le", F.explode(F.array(*[F.lit(b) for b in bounds]))
    )
    return _counter(grid, counts, ["series", "le"]).select("series", "le", "t", "v")


def lag(spark: SparkSession, sf_dir: str, step_s: int = STEP) -> DataFrame:
    """Lag gauge per partition: commits run six hours behind and freeze for two days."""
    counts = (
        feed_of(events(spark, sf_dir))
        .groupBy(F.col("record_partition").alias("series"), tick_of("appended_at", step_s).alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = _per_series(ticks(spark, sf_dir, step_s), "series", ORDERS_PARTITIONS)
    ends = _counter(grid, counts, ["series"])
    seen = F.when(
        (F.col("t") >= FREEZE_FROM) & (F.col("t") < FREEZE_TO), F.lit(FREEZE_FROM).cast("long")
    ).otherwise(F.col("t"))
    commits = ends.select("series", F.col("t").alias("seen"), F.col("v").alias("committed"))
    return (
        ends.withColumn("seen", seen - COMMIT_DELAY)
        .join(commits, ["series", "seen"], "left")
        .select("series", "t", lag_of(F.col("v"), F.col("committed")).alias("v"))
    )


def produced_and_consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both counters per tick; consumption trails by one tick.

    What falls into the quiet stretch is sent at its end, so every record is counted.
    """
    at = epoch_seconds(F.col("ts"))
    held_back = (at >= QUIET_FROM) & (at < QUIET_TO)
    sent = F.when(held_back, F.lit(QUIET_TO).cast("long")).otherwise(tick_of("ts"))
    counts = (
        events(spark, sf_dir)
        .groupBy(sent.alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    made = _counter(ticks(spark, sf_dir), counts, []).select("t", "v")
    trailing = made.select((F.col("t") + STEP).alias("tick"), F.col("v").alias("consumed"))
    return (
        made.select(F.col("t").alias("tick"), F.col("v").alias("produced"))
        .join(trailing, "tick", "left")
        .withColumn("consumed", F.coalesce("consumed", F.lit(0).cast("long")))
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics in one long table."""
    parts = {
        "orders_consumed": consumed(spark, sf_dir),
        "dlq_received": dead_letters(spark, sf_dir),
        "e2e_latency_bucket": latency_buckets(spark, sf_dir),
        "consumer_lag": lag(spark, sf_dir),
    }

    def long_form(name: str, part: DataFrame) -> DataFrame:
        series = F.col("series") if "series" in part.columns else F.lit(0)
        le = F.col("le") if "le" in part.columns else F.lit(None).cast("double")
        return part.select(
            F.lit(name).alias("name"), series.cast("int").alias("series"), le.alias("le"), "t", "v"
        )

    return reduce(DataFrame.unionByName, [long_form(n, p) for n, p in parts.items()])
