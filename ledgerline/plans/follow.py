"""Queries that follow something over time: alert stretches, replay chains, stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.buckets import minute_of
from ledgerline.functions.payload import ORDER, classify
from ledgerline.operators.lineage import lineage, replay_links
from ledgerline.operators.sketches import RANK_ERROR, estimates, merged_sketches, rank_spans, sketched
from ledgerline.plans.alerts import OWN, own_growth
from ledgerline.plans.orders import applied_orders
from ledgerline.plans.registry import query
from ledgerline.plans.sqlparts import fine_parts, full_growth_parts, select, stretch_parts
from ledgerline.plans.streams import dead_letters_landed
from ledgerline.schemas import LANDED
from ledgerline.session import fresh_folder, kept, streaming_session
from ledgerline.sources import samples
from ledgerline.streaming.alerts import read_stretches, watch
from ledgerline.streaming.outputs import read_replay_log, read_table
from ledgerline.streaming.replay import replay_all

RUNS = 4  # of the alert stream, each from the checkpoint of the one before
GROWING = OWN["dlq_growing"]


@query("stream_alerts", select(f"""
    SELECT '{GROWING.alert}' AS alert, '{GROWING.severity}' AS severity,
           CAST(make_timestamp(CAST(since AS BIGINT) * 1000000) AS TIMESTAMP) AS since,
           CAST(make_timestamp(CAST(max(tick) AS BIGINT) * 1000000) AS TIMESTAMP) AS until,
           count(*) AS ticks, max(tick) - since >= {GROWING.hold_s} AS fired
    FROM stretches GROUP BY since
    HAVING max(tick) + {GROWING.step_s * 1.5} <= (SELECT max(tick) FROM grown) - 60""", "decoded",
    **fine_parts(GROWING.step_s, "decoded", "kind = 'poison'", {}),
    **full_growth_parts([], GROWING.range_s),
    **stretch_parts("grown", "increase > 0", GROWING.step_s)))
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule on growing dead letters as a stream: its closed stretches, over several runs."""
    session, root = streaming_session(spark), fresh_folder(spark, "alerts")
    rows = own_growth(samples.dead_letters(spark, sf_dir, GROWING.step_s), [], GROWING)
    evaluations = kept(rows.select(
        F.lit(GROWING.alert).alias("alert"), "tick", F.timestamp_seconds("tick").alias("eval_ts"),
        F.col("increase").alias("value"),
    ), "evaluations")
    lo, hi = evaluations.agg(F.min("tick"), F.max("tick")).first()
    cuts = [(lo or 0) + ((hi or 0) + 1 - (lo or 0)) * i // RUNS for i in range(RUNS + 1)]
    for first, past in zip(cuts, cuts[1:]):
        piece = evaluations.filter((F.col("tick") >= first) & (F.col("tick") < past)).drop("tick")
        piece.write.mode("append").parquet(f"{root}/evaluations")
        watch(session, f"{root}/evaluations", root, GROWING).awaitTermination()
    found = read_stretches(spark, root)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("since", "until")})


@query("replay_lineage", select("""
    SELECT ingest_seq AS original, CAST(2 AS BIGINT) AS replays, CAST(2 AS INTEGER) AS depth,
           ingest_seq + 11 * (SELECT max(ingest_seq) + 1 FROM feed) AS last_id,
           CASE WHEN payload LIKE '%"amountCents":"abc"%' THEN 'applied' ELSE 'waiting' END AS outcome
    FROM decoded WHERE kind = 'poison'""", "decoded"))
def replay_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dead letter sent twice, unchanged and then with readable amounts: what became of it."""
    session, root, landing, drain, past = dead_letters_landed(spark, sf_dir, "lineage")
    repair = F.regexp_replace("payload", '"amountCents":"abc"', '"amountCents":100')
    for replay_id, base, how in (("as-is", past, None), ("repaired", 10 * past, repair)):
        replay_all(session, root, landing, replay_id, base, how)
        drain()
    landed = spark.read.schema(LANDED).parquet(landing)
    place = ["record_partition", "record_offset"]
    links = replay_links(
        read_replay_log(spark, root), landed.filter(F.col("ingest_seq") >= past).select("ingest_seq", "record_key")
    )
    applied = landed.select("ingest_seq", *place).join(read_table(spark, root, "ledger").select(*place), place)
    good = classify(landed).filter(F.col("kind") == ORDER).select("ingest_seq")
    return lineage(read_table(spark, root, "quarantine"), links, applied, good)


PERCENTS = (50, 95, 99)


@query("latency_sketch", select("""
    SELECT day, samples, percent, true AS within FROM (
        SELECT CAST(date_trunc('day', minute) AS TIMESTAMP) AS day, count(*) AS samples FROM (
            SELECT date_trunc('minute', make_timestamp(produced_at * 1000)) AS minute FROM firsts)
        GROUP BY 1), (SELECT CAST(unnest([50, 95, 99]) AS INTEGER) AS percent)""", "firsts"))
def latency_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily percentiles merged from a sketch per minute: is each within the stated rank error?"""
    orders = applied_orders(spark, sf_dir).select(
        minute_of(F.col("produced_at")).alias("minute"), "latency_ms"
    )
    stored = kept(orders.withColumn("day", F.date_trunc("day", "minute").cast("timestamp_ntz")), "latencies")
    minutes = kept(sketched(stored, ["day", "minute"], "latency_ms"), "sketches")
    answers = estimates(merged_sketches(minutes, ["day"]), ["day"], PERCENTS)
    share, slack = F.col("percent") / 100, RANK_ERROR * F.col("samples")
    within = (F.col("under") - slack <= share * F.col("samples")) & (
        F.col("upto") + slack >= share * F.col("samples")
    )
    return rank_spans(stored, ["day"], "latency_ms", answers, PERCENTS).select(
        "day", "samples", "percent", within.alias("within")
    )
