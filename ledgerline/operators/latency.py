"""Latency snapshot by nearest rank, and the cumulative histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.blocked import running
from ledgerline.session import kept

# Histogram bounds in seconds; the last bucket takes everything.
BOUNDS = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0)

# Distinct values per block when ranks are counted.
VALUE_BLOCK = 1_024


def bound_label(bound: float) -> str:
    return "+Inf" if bound == float("inf") else f"{bound:g}"


def value_counts(samples: DataFrame, value: str = "latency_ms") -> DataFrame:
    return samples.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def snapshot(counted: DataFrame) -> DataFrame:
    """One row: count, min, p50, p95, p99, max.  No samples give zeros.

    ``counted`` holds distinct values ``v`` and how often each occurs (``n``): far fewer
    rows than there are samples, and none are gathered into one buffer.  The rank of a
    percentile is ``ceil(p * n)``, compared in whole numbers.
    """
    counted = kept(counted, "value-counts")
    ranked = running(
        counted.withColumn("block", F.expr(f"v div {VALUE_BLOCK}")),
        [],
        "block",
        "v",
        sums={"upto": F.col("n")},
    )
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).scalar()
    zero = F.lit(0).cast("long")

    def at(percent: int):
        reached = F.col("upto") * 100 >= F.col("total") * percent
        return F.coalesce(F.min(F.when(reached, F.col("v"))), zero)

    return ranked.withColumn("total", total).agg(
        F.coalesce(F.max("total"), zero).alias("samples"),
        F.coalesce(F.min("v"), zero).alias("min_ms"),
        at(50).alias("p50_ms"),
        at(95).alias("p95_ms"),
        at(99).alias("p99_ms"),
        F.coalesce(F.max("v"), zero).alias("max_ms"),
    )


def histogram(samples: DataFrame, value: str = "latency_ms", bounds=BOUNDS) -> DataFrame:
    """Cumulative counts per upper bound, from one pass of conditional counts."""
    seconds = F.col(value) / 1000.0
    counts = samples.agg(
        *[F.count_if(seconds <= b).alias(bound_label(b)) for b in bounds],
        F.count(value).alias("+Inf"),
    )
    labels = [*map(bound_label, bounds), "+Inf"]
    return counts.unpivot([], [F.col(f"`{c}`") for c in labels], "le", "cumulative")
