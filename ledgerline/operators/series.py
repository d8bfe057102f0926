"""Metric series: counter growth over ranges, quantiles from buckets, instant values.

Samples carry ``t`` (whole seconds) and ``v``; samples without either are passed over.  A value
"at a tick" looks back over a closed range, as the dashboard's expressions do.

Ranges overlap, samples are not copied to each of them.  Samples are folded into panes, one per
key and step; panes are worked on in blocks as long as a range, which therefore ends one block and
begins the next: a range is the rest of a block and the beginning of the one after it, two rows a
tick whatever the range.  Work is split by (series, block) and (series, tick), not by series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DAY = 86_400


def day_of(seconds: str) -> Column:
    return F.expr(f"{seconds} div {DAY}")


def _in_panes(samples: DataFrame, keys: list[str], range_s: int, step_s: int) -> DataFrame:
    """Samples with the number of their pane and block; pane ``p`` ends at tick ``p * step_s``."""
    panes = max(range_s // step_s, 1)
    at = F.expr(f"(t + pmod(-t, {step_s})) div {step_s}").cast("long")
    return (
        samples.filter(F.col("t").isNotNull() & F.col("v").isNotNull())
        .select(*keys, "t", "v", at.alias("_pane"))
        .withColumn("_block", F.expr(f"(_pane - pmod(_pane, {panes})) div {panes}"))
    )


def _fold(first: Column, last: Column, rows: dict[str, Column]) -> Column:
    """A fold, and the panes at whose ticks it counts."""
    return F.struct(
        first.alias("first"), last.alias("last"), *[rows[c].alias(c) for c in ("n", "t0", "v0", "t1", "v1", "lost")]
    )


def halves(samples: DataFrame, keys: list[str], range_s: int, step_s: int) -> DataFrame:
    """At most two folds per key and tick, which together hold the samples of its range.

    A fold is the number of samples, the first and last with their times, and what restarts
    between its samples lost.  A tick's range is the panes up to it, as many as fit into the
    range, and of the pane before these the samples from the range's beginning on (its tail).
    """
    panes = range_s // step_s
    block = Window.partitionBy(*keys, "_block")
    before = F.lag("v").over(block.orderBy("t"))
    linked = _in_panes(samples, keys, range_s, step_s).withColumn(
        "lost", F.when(F.col("v") < before, before).otherwise(F.lit(0).cast("long"))
    )
    in_tail = F.col("t") >= F.col("_pane") * step_s - range_s % step_s
    tail = {c: F.when(in_tail, F.col(c)) for c in ("t", "v", "lost")}
    folded = linked.groupBy(*keys, "_block", "_pane").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("t").alias("t0"),
        F.min_by("v", "t").alias("v0"),
        F.max("t").alias("t1"),
        F.max_by("v", "t").alias("v1"),
        # The restart seen by a fold's first sample happened before the fold.
        F.sum("lost").alias("lost"),
        F.min_by("lost", "t").alias("entry"),
        F.count(tail["t"]).alias("tail_n"),
        F.min(tail["t"]).alias("tail_t0"),
        F.min_by(tail["v"], tail["t"]).alias("tail_v0"),
        (F.sum(tail["lost"]) - F.min_by(tail["lost"], tail["t"])).alias("tail_lost"),
    )
    ordered = block.orderBy("_pane")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = ordered.rowsBetween(1, Window.unboundedFollowing)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = folded.select(
        "*",
        F.lag("_pane").over(ordered).alias("earlier"),
        F.lead("_pane").over(ordered).alias("later"),
        F.first("t0").over(upto).alias("block_t0"),
        F.first("v0").over(upto).alias("block_v0"),
        F.last("t1").over(whole).alias("block_t1"),
        F.last("v1").over(whole).alias("block_v1"),
        F.sum("n").over(upto).alias("upto_n"),
        F.sum("lost").over(upto).alias("upto_lost"),
        F.coalesce(F.sum("n").over(after), F.lit(0)).alias("after_n"),
        F.coalesce(F.sum("lost").over(after), F.lit(0)).alias("after_lost"),
        F.first("t0").over(after).alias("after_t0"),
        F.first("v0").over(after).alias("after_v0"),
        F.first("entry").over(after).alias("after_entry"),
    )
    c, pane, start = F.col, F.col("_pane"), F.col("_block") * max(panes, 1)
    from_here = {
        "n": c("n") + c("after_n"), "t0": c("t0"), "v0": c("v0"),
        "t1": c("block_t1"), "v1": c("block_v1"), "lost": c("lost") - c("entry") + c("after_lost"),
    }
    has_tail = c("tail_n") > 0
    from_tail = {
        "n": c("tail_n") + c("after_n"),
        "t0": F.coalesce("tail_t0", "after_t0"), "v0": F.coalesce("tail_v0", "after_v0"),
        "t1": c("block_t1"), "v1": c("block_v1"),
        "lost": F.when(has_tail, c("tail_lost")).otherwise(-c("after_entry")) + c("after_lost"),
    }
    to_here = {
        "n": c("upto_n"), "t0": c("block_t0"), "v0": c("block_v0"),
        "t1": c("t1"), "v1": c("v1"), "lost": c("upto_lost"),
    }
    if panes:
        folds = [
            _fold(F.coalesce(c("earlier") + 1, start) + panes, pane - 1 + panes, from_here),
            _fold(pane + panes, pane + panes, from_tail),
            _fold(pane, F.coalesce(c("later"), start + panes) - 1, to_here),
        ]
    else:  # ranges shorter than a step: tails only
        folds = [_fold(pane, pane, from_tail)]
    return (
        placed.select(*keys, F.inline(F.array(*folds)))
        .filter((c("n") > 0) & (c("first") <= c("last")))
        .select(*keys, F.explode(F.sequence("first", "last")).alias("_pane"), "n", "t0", "v0", "t1", "v1", "lost")
        .select(*keys, (c("_pane") * step_s).alias("tick"), "n", "t0", "v0", "t1", "v1", "lost")
    )


def growth(
    samples: DataFrame,
    keys: list[str],
    range_s: int,
    step_s: int,
    until: Column | None = None,
) -> DataFrame:
    """Counter growth per key and tick over the range, aware of restarts.

    Gives the exact growth between the first and last sample in range (``growth``) and
    the growth extrapolated towards the range's edges (``increase``).  Fewer than two
    instants give no row: without a span there is nothing to stretch.  ``until`` stops the ticks at the last evaluation time.
    """
    spread = halves(samples, keys, range_s, step_s)
    if until is not None:
        spread = spread.filter(F.col("tick") <= until)
    entered, left = F.max_by("v0", "t0"), F.min_by("v1", "t0")
    seam = F.when((F.count(F.lit(1)) > 1) & (entered < left), left).otherwise(F.lit(0))
    sums = spread.groupBy(*keys, "tick").agg(
        F.sum("n").alias("n"),
        F.min("t0").alias("t0"),
        F.max("t1").alias("t1"),
        F.min_by("v0", "t0").alias("v0"),
        F.max_by("v1", "t1").alias("v1"),
        (F.sum("lost") + seam).alias("lost"),
    )
    gained = F.col("v1") - F.col("v0") + F.col("lost")
    return (
        sums.filter(F.col("t1") > F.col("t0"))
        .withColumn("growth", gained)
        .select(*keys, "tick", "growth", _extrapolated(range_s).alias("increase"))
    )


def _extrapolated(range_s: int) -> Column:
    """Growth stretched to the range's edges, unless a sample is missing there.

    An edge further away than 1.1 mean gaps is taken to lie half a gap away, and a
    counter is never stretched back past the time it would have been zero.
    """
    covered = (F.col("t1") - F.col("t0")).cast("double")
    gap = covered / (F.col("n") - 1)
    head = (F.col("t0") - (F.col("tick") - range_s)).cast("double")
    tail = (F.col("tick") - F.col("t1")).cast("double")
    head = F.when(head >= gap * 1.1, gap / 2).otherwise(head)
    tail = F.when(tail >= gap * 1.1, gap / 2).otherwise(tail)
    # try_divide: no growth gives null, which least() passes over.
    to_zero = F.try_divide(covered * F.col("v0"), F.col("growth"))
    return F.col("growth") * (covered + F.least(head, to_zero) + tail) / covered


def per_second(increase: Column, range_s: int) -> Column:
    return increase / F.lit(float(range_s))


def instant(
    samples: DataFrame, keys: list[str], lookback_s: int, step_s: int, until: Column | None = None
) -> DataFrame:
    """Latest value per key at each tick, no older than the look-back.

    A pane's last sample counts until the next pane of its block that has one, so a tick
    gets a row from each of two blocks at most.
    """
    ordered = Window.partitionBy(*keys, "_block").orderBy("_pane")
    lasts = (
        _in_panes(samples, keys, lookback_s, step_s)
        .groupBy(*keys, "_block", "_pane")
        .agg(F.max("t").alias("t"), F.max_by("v", "t").alias("v"))
        .withColumn("_later", F.lead("_pane").over(ordered) - 1)
        .withColumn("_to", F.least("_later", F.expr(f"(t + {lookback_s} - pmod(t + {lookback_s}, {step_s})) div {step_s}")))
        .filter(F.col("_pane") <= F.col("_to"))
    )
    spread = lasts.select(*keys, "t", "v", F.explode(F.sequence("_pane", "_to")).alias("tick"))
    spread = spread.withColumn("tick", F.col("tick") * step_s)
    if until is not None:
        spread = spread.filter(F.col("tick") <= until)
    return spread.groupBy(*keys, "tick").agg(F.max_by("v", "t").alias("v"))


def latest(samples: DataFrame, keys: list[str], as_of_s: Column, lookback_s: int) -> DataFrame:
    """Latest value per key at one time."""
    fresh = samples.filter((F.col("t") <= as_of_s) & (F.col("t") >= as_of_s - lookback_s))
    return fresh.groupBy(*keys).agg(F.max("t").alias("t"), F.max_by("v", "t").alias("v"))


def quantiles(buckets: DataFrame, by: list[str], ranks: tuple[float, ...]) -> DataFrame:
    """Quantiles from cumulative buckets (``le``, ``cum``), interpolated within a bucket.

    No observations give null.  The open top bucket gives the bound below it.  The
    windows hold one row per bucket bound.
    """
    upwards = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    rows = (
        buckets
        # Rounding may leave a bucket below its neighbour: never go down.
        .withColumn("cum", F.max("cum").over(upwards.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("below", F.coalesce(F.lag("cum").over(upwards), F.lit(0)).cast("double"))
        .withColumn("low", F.coalesce(F.lag("le").over(upwards), F.lit(0.0)))
        .withColumn("total", F.max("cum").over(whole).cast("double"))
        .withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in ranks])))
    )
    rank = F.col("q") * F.col("total")
    hit = (F.col("cum") >= rank) & (F.col("total") > 0)
    inside = F.col("low") + (F.col("le") - F.col("low")) * (
        F.try_divide(rank - F.col("below"), F.col("cum") - F.col("below"))
    )
    value = F.when(F.col("le") == float("inf"), F.col("low")).otherwise(inside)
    return rows.groupBy(*by, "q").agg(
        F.min_by(F.when(hit, value), F.when(hit, F.col("le"))).alias("value")
    )
