"""Metric series, dashboard expressions and alert rules.

On the fixture's hourly grid the rules are taken with hours for minutes and lower limits, as its
lags are small; the ``_dense`` queries take them as they are, every 15 seconds.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline import schemas
from ledgerline.functions.buckets import from_seconds
from ledgerline.operators.holds import by_rule, drained
from ledgerline.operators.latency import BOUNDS, bound_label
from ledgerline.operators.series import growth, instant, latest, per_second, quantiles
from ledgerline.plans.registry import query
from ledgerline.plans.sqlparts import (
    fine_parts,
    full_growth_parts,
    growth_parts,
    quantile_parts,
    ranked_parts,
    select,
    stretch_parts,
)
from ledgerline.session import kept
from ledgerline.sources import samples

HOUR = samples.STEP
RANGE = 3 * HOUR
FIXTURE = {
    "lag_high": {"threshold": 20, "hold_s": 2 * HOUR},
    "lag_critical": {"threshold": 50, "hold_s": 2 * HOUR},
    "dlq_growing": {"hold_s": 3 * HOUR, "range_s": RANGE},
    "p99_high": {"hold_s": 3 * HOUR, "range_s": RANGE},
}
RULES = {name: replace(rule, step_s=HOUR, **FIXTURE[name]) for name, rule in schemas.RULES.items()}
RANKS = (0.5, 0.95, 0.99)
AS_OF_SECONDS = 1_705_708_800  # 2024-01-20 00:00

_TIME = "make_timestamp(CAST(tick AS BIGINT) * 1000000) AS eval_ts"


def grown(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Growth over the range at every tick, up to the last sample."""
    stored = kept(rows, "samples")
    return growth(stored, keys, RANGE, HOUR, stored.agg(F.max("t")).scalar())


def own_growth(rows: DataFrame, keys: list[str], rule: schemas.Rule) -> DataFrame:
    """Growth over a rule's own range at its own ticks, up to the last sample."""
    stored = kept(rows, "samples")
    return growth(stored, keys, rule.range_s, rule.step_s, stored.agg(F.max("t")).scalar())


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumn("eval_ts", from_seconds(F.col("tick"))).drop("tick")


@query("metric_samples", select("""
    SELECT name, series, le, make_timestamp(t * 1000000) AS t, v FROM (
        SELECT 'orders_consumed' AS name, series, '' AS le, t, v FROM consumed
        UNION ALL SELECT 'dlq_received', 0, '', t, v FROM dead
        UNION ALL SELECT 'e2e_latency_bucket', series,
                         CASE WHEN isinf(le) THEN '+Inf' ELSE printf('%g', le) END, t, v FROM buckets
        UNION ALL SELECT 'consumer_lag', series, '', t, v FROM lag)""",
    "consumed", "dead", "buckets", "lag"))
def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.coalesce(
        *[F.when(F.col("le") == b, bound_label(b)) for b in (*BOUNDS, float("inf"))], F.lit("")
    )
    return samples.metric_samples(spark, sf_dir).select(
        "name", "series", label.alias("le"), from_seconds(F.col("t")).alias("t"), "v"
    )


@query("latest_sample", select(f"""
    SELECT series, make_timestamp(max(t) * 1000000) AS t, arg_max(v, t) AS v
    FROM consumed WHERE t BETWEEN {AS_OF_SECONDS - HOUR} AND {AS_OF_SECONDS}
    GROUP BY series""", "consumed"))
def latest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(AS_OF_SECONDS).cast("long")
    rows = latest(samples.consumed(spark, sf_dir), ["series"], as_of, HOUR)
    return rows.withColumn("t", from_seconds(F.col("t")))


@query("counter_increase", select(f"""
    SELECT series, {_TIME}, growth, CAST(round(increase * 1000) AS BIGINT) AS increase_milli
    FROM grown""", "consumed", **growth_parts("consumed", ["series"], RANGE)))
def counter_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grown(samples.consumed(spark, sf_dir), ["series"])
    milli = F.round(F.col("increase") * 1000).cast("long")
    return _shown(rows.select("series", "tick", "growth", milli.alias("increase_milli")))


@query("counter_rate", select(f"""
    SELECT {_TIME}, CAST(round(sum(increase) / {float(RANGE)} * 1000000) AS BIGINT) AS rate_micro
    FROM grown GROUP BY tick""", "consumed", **growth_parts("consumed", ["series"], RANGE)))
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records consumed per second over all series."""
    rows = grown(samples.consumed(spark, sf_dir), ["series"])
    rate = per_second(F.sum("increase"), RANGE)
    return _shown(rows.groupBy("tick").agg(F.round(rate * 1_000_000).cast("long").alias("rate_micro")))


def latency_quantiles(spark: SparkSession, sf_dir: str, ranks: tuple[float, ...]) -> DataFrame:
    """Quantiles per tick: growth per bucket, summed over instances, interpolated.

    Growth is left undivided by the range: a common factor does not move a quantile.
    """
    buckets = grown(samples.latency_buckets(spark, sf_dir), ["series", "le"])
    by_bound = buckets.groupBy("tick", "le").agg(F.sum("increase").alias("cum"))
    return quantiles(by_bound, ["tick"], ranks)


@query("latency_quantile_series", select(f"""
    SELECT {_TIME}, CAST(round(q * 100) AS INTEGER) AS percentile,
           CAST(round(value * 1000000) AS BIGINT) AS value_us FROM quants""",
    "buckets", **quantile_parts(RANGE, RANKS)))
def latency_quantile_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latency_quantiles(spark, sf_dir, RANKS)
    return _shown(rows.select(
        "tick",
        F.round(F.col("q") * 100).cast("int").alias("percentile"),
        F.round(F.col("value") * 1_000_000).cast("long").alias("value_us"),
    ))


def worst_lag(spark: SparkSession, sf_dir: str, step_s: int = HOUR) -> DataFrame:
    """Largest lag per tick, and the (lowest) partition that has it."""
    stored = kept(samples.lag(spark, sf_dir, step_s), "samples")
    now = instant(stored, ["series"], 300, step_s, stored.agg(F.max("t")).scalar())
    worst = F.max(F.struct("v", (-F.col("series")).alias("s")))
    return now.groupBy("tick").agg(worst.alias("w")).select(
        "tick", F.col("w.v").alias("lag"), (-F.col("w.s")).alias("record_partition")
    )


def _rule_sql(rule: schemas.Rule, columns: str) -> str:
    return f"""
        SELECT '{rule.alert}' AS alert, '{rule.severity}' AS severity,
               CAST({rule.threshold} AS DOUBLE) AS threshold, {_TIME}, {columns},
               make_timestamp(CAST(since AS BIGINT) * 1000000) AS since,
               CASE WHEN tick - since >= {rule.hold_s} THEN 'firing' ELSE 'pending' END AS state
        FROM stretches"""


def _lag_sql(rule: schemas.Rule) -> str:
    return select(_rule_sql(rule, "lag, record_partition"), "lag",
        worst="""SELECT t AS tick, max(v) AS lag,
                        CAST(arg_max(series, v * 100 - series) AS INTEGER) AS record_partition
                 FROM lag GROUP BY t""",
        **stretch_parts("worst", f"lag > {rule.threshold}", HOUR))


def _alert_rows(rows: DataFrame) -> DataFrame:
    return _shown(rows.withColumn("since", from_seconds(F.col("since"))))


@query("alert_lag_high", _lag_sql(RULES["lag_high"]))
def alert_lag_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = kept(worst_lag(spark, sf_dir), "worst-lag")
    return _alert_rows(by_rule(worst, "lag", RULES["lag_high"]))


@query("alert_lag_critical", _lag_sql(RULES["lag_critical"]))
def alert_lag_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = kept(worst_lag(spark, sf_dir), "worst-lag")
    return _alert_rows(by_rule(worst, "lag", RULES["lag_critical"]))


@query("alert_dlq_growing", select(_rule_sql(RULES["dlq_growing"], "growth"), "dead",
    **growth_parts("dead", [], RANGE), **stretch_parts("grown", "increase > 0", HOUR)))
def alert_dlq_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    growing = kept(grown(samples.dead_letters(spark, sf_dir), []), "growth")
    return _alert_rows(by_rule(growing, "increase", RULES["dlq_growing"]).drop("increase"))


# The rules as they are: evaluated every 15 seconds over the whole span of the table.
OWN = schemas.RULES
_FINE = OWN["dlq_growing"].step_s
# Small feeds never reach the published limits of the lag rules; both are evaluated.
LAG_RULES = [rule for name in ("lag_high", "lag_critical") for rule in (
    OWN[name], replace(OWN[name], threshold=RULES[name].threshold))]


@query("alert_dlq_dense", select(
    _rule_sql(OWN["dlq_growing"], "growth"), "decoded",
    **fine_parts(_FINE, "decoded", "kind = 'poison'", {}),
    **full_growth_parts([], OWN["dlq_growing"].range_s),
    **stretch_parts("grown", "increase > 0", _FINE)))
def alert_dlq_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule as it is: 5 minutes' growth, every 15 seconds, held for 5 minutes."""
    rule = OWN["dlq_growing"]
    growing = kept(own_growth(samples.dead_letters(spark, sf_dir, rule.step_s), [], rule), "growth")
    return _alert_rows(by_rule(growing, "increase", rule).drop("increase"))


@query("alert_p99_dense", select(
    _rule_sql(OWN["p99_high"], "CAST(round(value * 1000000) AS BIGINT) AS p99_us"), "firsts", "bounds",
    by_bound="""
        SELECT appended_at, CAST(ingest_seq % 3 AS INTEGER) AS series, le FROM firsts, bounds
        WHERE latency_ms / 1000.0 <= le""",
    **fine_parts(_FINE, "by_bound", "true", {
        "series": "SELECT CAST(unnest(range(3)) AS INTEGER) AS series", "le": "SELECT le FROM bounds"}),
    **full_growth_parts(["series", "le"], OWN["p99_high"].range_s),
    **ranked_parts((0.99,)),
    **stretch_parts("quants", f"value > {OWN['p99_high'].threshold}", _FINE)))
def alert_p99_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule as it is: p99 of 5 minutes over two seconds, every 15 seconds, for 5 minutes."""
    rule = OWN["p99_high"]
    fine = samples.latency_buckets(spark, sf_dir, rule.step_s)
    by_bound = own_growth(fine, ["series", "le"], rule).groupBy("tick", "le").agg(
        F.sum("increase").alias("cum")
    )
    p99 = kept(quantiles(by_bound, ["tick"], (0.99,)), "p99")
    micros = F.round(F.col("value") * 1_000_000).cast("long")
    return _alert_rows(by_rule(p99, "value", rule).withColumn("p99_us", micros).drop("value", "q"))


@query("alert_lag_dense", select(
    " UNION ALL ".join(
        f"(WITH {', '.join(f'{n} AS ({body})' for n, body in stretch_parts('worst', f'lag > {r.threshold}', _FINE).items())}"
        f" {_rule_sql(r, 'lag, record_partition')})" for r in LAG_RULES),
    "feed",
    **fine_parts(_FINE, "feed", "true", {"series": "SELECT CAST(unnest(range(12)) AS INTEGER) AS series"},
                 {"series": "record_partition"}),
    worst=f"""
        SELECT e.t AS tick, max(greatest(0, e.v - coalesce(c.v, 0))) AS lag,
               CAST(arg_max(e.series, greatest(0, e.v - coalesce(c.v, 0)) * 100 - e.series) AS INTEGER)
                   AS record_partition
        FROM samples e LEFT JOIN samples c ON c.series = e.series
             AND c.t = CASE WHEN e.t >= {samples.FREEZE_FROM} AND e.t < {samples.FREEZE_TO}
                            THEN {samples.FREEZE_FROM} ELSE e.t END - {samples.COMMIT_DELAY}
        GROUP BY e.t"""))
def alert_lag_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lag rules every 15 seconds, held for a minute: at their limits and at the fixture's."""
    worst = kept(worst_lag(spark, sf_dir, _FINE), "worst-lag")
    return _alert_rows(reduce(DataFrame.unionByName, [by_rule(worst, "lag", r) for r in LAG_RULES]))


@query("alert_p99_high", select(
    _rule_sql(RULES["p99_high"], "CAST(round(value * 1000000) AS BIGINT) AS p99_us"),
    "buckets", **quantile_parts(RANGE, (0.99,)),
    **stretch_parts("quants", f"value > {RULES['p99_high'].threshold}", HOUR)))
def alert_p99_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    p99 = kept(latency_quantiles(spark, sf_dir, (0.99,)), "p99")
    micros = F.round(F.col("value") * 1_000_000).cast("long")
    return _alert_rows(
        by_rule(p99, "value", RULES["p99_high"]).withColumn("p99_us", micros).drop("value", "q")
    )


@query("quiescence", select(f"""
    SELECT {_TIME}, produced, consumed,
           CAST((tick - since) / {HOUR} + 1 AS INTEGER) AS stable_ticks
    FROM stretches WHERE (tick - since) / {HOUR} + 1 >= 3""", "grid",
    made="""
        SELECT g.t AS tick,
               (SELECT count(*) FROM events e
                WHERE CASE WHEN epoch_us(e.ts) >= 1705708800000000
                                AND epoch_us(e.ts) < 1705726800000000
                           THEN 1705726800000000 ELSE epoch_us(e.ts) END <= g.t * 1000000) AS produced
        FROM grid g""",
    paired=f"""
        SELECT *, lag(consumed) OVER (ORDER BY tick) AS earlier FROM (
            SELECT m.tick, m.produced, coalesce(p.produced, 0) AS consumed
            FROM made m LEFT JOIN made p ON p.tick = m.tick - {HOUR})""",
    **stretch_parts("paired", "consumed >= produced AND produced > 0 AND consumed = earlier", HOUR)))
def quiescence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(drained(samples.produced_and_consumed(spark, sf_dir), HOUR))
