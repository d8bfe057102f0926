"""Percentiles of any span from sketches that are stored once per minute.

A KLL sketch has a fixed size whatever it has seen, and sketches merge in any order.  Spans are
answered from the minutes' sketches without going back to the samples; the rank of an answer is
off by a share of the samples that depends on the sketch's size only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SIZE = 800
RANK_ERROR = 0.01  # share of the samples; at this size nearly twice the error of 99 answers in 100


def sketched(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    """One sketch per group, with the number of its samples; null values are passed over."""
    return samples.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.kll_sketch_agg_bigint(F.col(value), F.lit(SIZE)).alias("sketch"), F.count(value).alias("samples")
    )


def merged_sketches(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_bigint("sketch", F.lit(SIZE)).alias("sketch"), F.sum("samples").alias("samples")
    )


def estimates(sketches: DataFrame, by: list[str], percents: tuple[int, ...]) -> DataFrame:
    """Rows of (group, percent, value): the sketch's value at each percentile."""
    pairs = [
        F.struct(F.lit(p).alias("percent"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(p / 100)).alias("value"))
        for p in percents
    ]
    return sketches.select(*by, "samples", F.inline(F.array(*pairs)))


def rank_spans(samples: DataFrame, by: list[str], value: str, answers: DataFrame, percents: tuple[int, ...]) -> DataFrame:
    """Exact ranks of the answers: samples below each (``under``) and up to it (``upto``).

    Answers are turned into one row per group first, so every sample meets one row and is counted
    for all percentiles in one aggregate.
    """
    wide = answers.groupBy(*by).agg(
        F.first("samples").alias("samples"),
        *[F.max(F.when(F.col("percent") == p, F.col("value"))).alias(f"q{p}") for p in percents],
    )
    same = reduce(Column.__and__, [F.col(f"s.{k}").eqNullSafe(F.col(f"w.{k}")) for k in by], F.lit(True))
    met = samples.filter(F.col(value).isNotNull()).alias("s").join(wide.alias("w"), same)
    sample = F.col(f"s.{value}")
    counted = met.groupBy(*[F.col(f"w.{k}") for k in by]).agg(
        F.first("samples").alias("samples"),
        *[F.struct(
            F.lit(p).alias("percent"), F.first(f"q{p}").alias("value"),
            F.count_if(sample < F.col(f"q{p}")).alias("under"), F.count_if(sample <= F.col(f"q{p}")).alias("upto"),
        ).alias(f"p{p}") for p in percents],
    )
    return counted.select(*by, "samples", F.inline(F.array(*[F.col(f"p{p}") for p in percents])))
