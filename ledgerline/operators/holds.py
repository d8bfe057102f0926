"""Conditions that must hold for a while: alert states and the drained signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.operators.blocked import previous
from ledgerline.operators.series import day_of
from ledgerline.schemas import Rule


def stretches(evaluations: DataFrame, condition: Column, step_s: int) -> DataFrame:
    """Ticks at which the condition is true, with the tick their stretch began at.

    A false, null or missing tick ends a stretch.  Only true ticks are kept, so quiet
    periods cost nothing.  As in :mod:`ledgerline.operators.blocked`, days are worked on
    separately and one row per day carries over where an open stretch began.
    """
    inside = Window.partitionBy("day").orderBy("tick")
    gap = F.col("tick") - F.lag("tick").over(inside) > step_s
    true_ticks = (
        evaluations.filter(condition)
        .withColumn("day", day_of("tick"))
        .withColumn("_start", F.when(gap, F.col("tick")))
    )
    days = Window.orderBy("day")
    ends = true_ticks.groupBy("day").agg(
        F.min("tick").alias("first"), F.max("tick").alias("last"), F.max("_start").alias("inner")
    )
    fresh = F.coalesce(F.col("first") - F.lag("last").over(days) > step_s, F.lit(True))
    carried = (
        ends.withColumn("opened", F.when(fresh, F.col("first")))
        .withColumn("latest", F.greatest("opened", "inner"))
        .select(
            "day",
            F.max("latest").over(days.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
            "opened",
        )
    )
    since = F.greatest(
        F.max("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "opened", "before"
    )
    return true_ticks.join(carried, "day").select(*evaluations.columns, since.alias("since"))


def alert(evaluations: DataFrame, condition: Column, hold_s: int, step_s: int) -> DataFrame:
    """Alert state at every tick at which the condition is true."""
    held = F.col("tick") - F.col("since") >= hold_s
    return stretches(evaluations, condition, step_s).withColumn(
        "state", F.when(held, "firing").otherwise("pending")
    )


def by_rule(evaluations: DataFrame, value: str, rule: Rule) -> DataFrame:
    """Alert rows of a rule: its name, severity and threshold with every state."""
    rows = alert(evaluations, F.col(value) > rule.threshold, rule.hold_s, rule.step_s)
    return rows.select(
        F.lit(rule.alert).alias("alert"),
        F.lit(rule.severity).alias("severity"),
        F.lit(float(rule.threshold)).alias("threshold"),
        "*",
    )


def drained(counters: DataFrame, step_s: int, ticks: int = 3) -> DataFrame:
    """Ticks at which consumption has caught up and stood still for ``ticks`` checks."""
    dated = counters.withColumn("day", day_of("tick"))
    linked = previous(dated, [], "day", "tick", {"earlier": "consumed"}).drop("day")
    still = (
        (F.col("consumed") >= F.col("produced"))
        & (F.col("produced") > 0)
        & (F.col("consumed") == F.col("earlier"))
    )
    streak = ((F.col("tick") - F.col("since")) / step_s + 1).cast("int")
    return (
        stretches(linked, still, step_s)
        .withColumn("stable_ticks", streak)
        .filter(F.col("stable_ticks") >= ticks)
        .drop("earlier", "since")
    )
