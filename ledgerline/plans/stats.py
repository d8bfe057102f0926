"""Latency, lag, counters and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.payload import ORDER, POISON
from ledgerline.operators.arrival import orders_of
from ledgerline.operators.lag import PARTITION, alert_count, by_partition, end_offsets, lag_as_of, total
from ledgerline.operators.deadletter import light
from ledgerline.operators.latency import histogram, snapshot, value_counts
from ledgerline.operators.reconcile import balanced, copies_by_key, identity, not_applied_once, one_row
from ledgerline.plans.orders import applied_orders, decoded, with_latency
from ledgerline.plans.registry import query
from ledgerline.plans.sqlparts import select
from ledgerline.session import kept
from ledgerline.sources import samples
from ledgerline.sources.feed import feed_of, with_offsets
from ledgerline.sources.tables import events

AS_OF = "2024-01-20 00:00:00"
ALERT_LAG = 20
TARGET_RATE = 10_000

_SNAPSHOT = """count(*) AS samples,
    CAST(coalesce(min(latency_ms), 0) AS BIGINT) AS min_ms,
    CAST(coalesce(quantile_disc(latency_ms, 0.5), 0) AS BIGINT) AS p50_ms,
    CAST(coalesce(quantile_disc(latency_ms, 0.95), 0) AS BIGINT) AS p95_ms,
    CAST(coalesce(quantile_disc(latency_ms, 0.99), 0) AS BIGINT) AS p99_ms,
    CAST(coalesce(max(latency_ms), 0) AS BIGINT) AS max_ms"""

_LAG = f"""
    SELECT e.topic, e.record_partition, e.end_offset, c.committed_offset,
           greatest(0, e.end_offset - coalesce(c.committed_offset, 0)) AS lag
    FROM (SELECT topic, record_partition, max(record_offset) + 1 AS end_offset FROM feed
          WHERE appended_at <= TIMESTAMP '{AS_OF}' GROUP BY topic, record_partition) e
    LEFT JOIN (SELECT topic, record_partition,
                      CASE WHEN record_partition = 10
                           THEN max(record_offset) + 6
                           ELSE max(record_offset) FILTER (
                                appended_at <= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR) + 1
                      END AS committed_offset
               FROM feed WHERE appended_at <= TIMESTAMP '{AS_OF}' AND record_partition <> 11
               GROUP BY topic, record_partition) c USING (topic, record_partition)"""


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends and commits at one time; see the fixture for partitions 10 and 11."""
    as_of = F.expr(f"TIMESTAMP_NTZ '{AS_OF}'")
    feed = with_offsets(feed_of(events(spark, sf_dir)).select(*PARTITION, "ingest_seq", "appended_at"))
    partition = F.col("record_partition")
    behind = F.when(partition == 10, as_of).otherwise(as_of - F.expr("INTERVAL 6 HOURS"))
    ahead = F.when(partition == 10, 5).otherwise(0)
    commits = end_offsets(feed.filter(partition != 11), behind).select(
        "topic", "record_partition", (F.col("end_offset") + ahead).alias("committed_offset")
    )
    return by_partition(end_offsets(feed, as_of), commits)


@query("latency_percentiles", select(f"SELECT {_SNAPSHOT} FROM firsts", "firsts"))
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(value_counts(with_latency(applied_orders(spark, sf_dir))))


@query("latency_histogram", select("""
    SELECT CASE WHEN isinf(le) THEN '+Inf' ELSE printf('%g', le) END AS le,
           (SELECT count(*) FROM firsts WHERE latency_ms / 1000.0 <= b.le) AS cumulative
    FROM bounds b""", "firsts", "bounds"))
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(with_latency(applied_orders(spark, sf_dir)))


@query("lag_by_partition", select(_LAG, "feed"))
def lag_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lags(spark, sf_dir)


@query("lag_total", select(
    f"SELECT CAST(sum(lag) AS BIGINT) AS total_lag FROM ({_LAG})", "feed"))
def lag_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total(lags(spark, sf_dir))


@query("lag_alert_count", select(f"""
    SELECT count(*) AS lag_alerts, CASE WHEN count(*) >= 1 THEN 'red' ELSE 'green' END AS light
    FROM lag WHERE v >= {ALERT_LAG}""", "lag"))
def lag_alert_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_count(samples.lag(spark, sf_dir), ALERT_LAG).withColumn(
        "light", light(F.col("lag_alerts"))
    )


def produced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records the producer sent, counted from its own table."""
    return events(spark, sf_dir).agg(F.count(F.lit(1)).alias("produced"))


@query("service_stats", select(f"""
    SELECT (SELECT count(*) FROM feed) AS produced, (SELECT count(*) FROM decoded) AS consumed,
           (SELECT count(*) FROM firsts) AS consumed_unique,
           (SELECT CAST(sum(amount_cents) AS BIGINT) FROM firsts) AS revenue_total_cents,
           (SELECT count(DISTINCT order_id) FROM orders_in) AS revenue_order_count,
           (SELECT count(*) FROM quarantine WHERE NOT replayed) AS dlq_pending,
           (SELECT CAST(sum(lag) AS BIGINT) FROM ({_LAG})) AS consumer_lag_total,
           (SELECT arg_max(schema_version, ingest_seq) FROM orders_in) AS schema_version
    """, "firsts", "quarantine"))
def service_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics row; what was produced is counted at the source, not behind the decoder."""
    rows = decoded(spark, sf_dir).withColumn(
        "waiting", (F.col("kind") == POISON) & (F.col("ingest_seq") % 400 >= 200)
    )
    is_order = F.col("kind") == ORDER
    counts = (
        rows.groupBy("kind", "order_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by("amount_cents", "ingest_seq").alias("amount_cents"),
            F.count_if("waiting").alias("waiting"),
        )
        .agg(
            F.sum("n").alias("consumed"),
            F.count_if(is_order).alias("consumed_unique"),
            F.sum("amount_cents").alias("revenue_total_cents"),
            F.count_if(is_order).alias("revenue_order_count"),
            F.sum("waiting").alias("dlq_pending"),
        )
    )
    version = orders_of(decoded(spark, sf_dir)).agg(
        F.max_by("schema_version", "ingest_seq").alias("schema_version")
    )
    lag = total(lags(spark, sf_dir)).withColumnRenamed("total_lag", "consumer_lag_total")
    return one_row(produced(spark, sf_dir), counts, version, lag)


@query("reconcile", select("""
    SELECT *, records = unique_orders + duplicates + poison + tombstones + unexpected AS balanced
    FROM (SELECT count(*) AS records, count(DISTINCT order_id) AS unique_orders,
                 count(order_id) - count(DISTINCT order_id) AS duplicates,
                 count(*) FILTER (kind = 'poison') AS poison,
                 count(*) FILTER (kind = 'tombstone') AS tombstones,
                 count(*) FILTER (kind = 'unexpected') AS unexpected FROM decoded)""", "decoded"))
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoder's kinds against the number of records that were sent."""
    kinds = identity(copies_by_key(decoded(spark, sf_dir))).drop("records", "balanced")
    return balanced(one_row(kinds, produced(spark, sf_dir).withColumnRenamed("produced", "records")))


@query("order_differences", select(f"""
    SELECT order_id, count(*) AS produced, CAST(0 AS BIGINT) AS applied FROM orders_in
    GROUP BY order_id HAVING min(appended_at) > TIMESTAMP '{AS_OF}'""", "orders_in"))
def unapplied_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent over the whole feed but not applied by a consumer that stopped half way."""
    applied = F.col("appended_at") <= F.expr(f"TIMESTAMP_NTZ '{AS_OF}'")
    sent = orders_of(decoded(spark, sf_dir)).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("produced"),
        F.max(applied.cast("long")).alias("applied"),
    )
    return not_applied_once(sent)


@query("throughput_report", select(f"""
    SELECT c.*, CAST({TARGET_RATE} AS BIGINT) AS target_rate,
           CAST(round(c.produced / (c.elapsed_ms / 1000.0)) AS BIGINT) AS achieved_rate,
           CAST(round(c.produced * 3600 / (c.elapsed_ms / 1000.0)) AS BIGINT) AS achieved_per_hour,
           s.*
    FROM (SELECT count(*) AS produced, count(kind) AS consumed,
                 count(DISTINCT order_id) AS unique_orders, count(*) - count(kind) AS lost,
                 epoch_us(max(appended_at) + to_milliseconds(0)) // 1000
                 - epoch_us(min(appended_at)) // 1000 AS elapsed_ms FROM decoded) c,
         (SELECT {_SNAPSHOT} FROM firsts) s""", "firsts"))
def throughput_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, rate over the feed's span, and the latency block.

    The feed is reduced once, to a row per (kind, latency), and the report reads that; what was
    produced is counted at the source.
    """
    millis = F.unix_millis(F.col("appended_at").cast("timestamp"))
    is_order = F.col("kind") == ORDER
    reduced = kept(
        decoded(spark, sf_dir)
        .withColumn("at", millis)
        .groupBy("kind", "order_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("at").alias("lo"),
            F.max("at").alias("hi"),
            *[F.min_by(c, "ingest_seq").alias(c) for c in ("produced_at", "latency_ms")],
        )
        .transform(with_latency)
        .groupBy("kind", F.when(is_order, F.col("latency_ms")).alias("v"))
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("n").alias("records"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        ),
        "report",
    )
    counts = reduced.agg(
        F.sum("records").alias("consumed"),
        F.sum(F.when(is_order, F.col("keys"))).alias("unique_orders"),
        (F.max("hi") - F.min("lo")).alias("elapsed_ms"),
    )
    latencies = reduced.filter(is_order).select("v", F.col("keys").alias("n"))
    seconds = F.col("elapsed_ms") / 1000.0
    return one_row(produced(spark, sf_dir), counts, snapshot(latencies)).withColumns({
        "lost": F.col("produced") - F.col("consumed"),
        "target_rate": F.lit(TARGET_RATE).cast("long"),
        "achieved_rate": F.round(F.col("produced") / seconds).cast("long"),
        "achieved_per_hour": F.round(F.col("produced") * 3600 / seconds).cast("long"),
    })


@query("lag_asof", select("""
    SELECT c.topic, c.record_partition, c.seq, c.moment, e.end_offset, c.committed_offset,
           greatest(0, e.end_offset - c.committed_offset) AS lag
    FROM (SELECT topic, record_partition, ingest_seq AS seq, moment,
                 max(record_offset + 1) OVER (PARTITION BY topic, record_partition ORDER BY moment, ingest_seq
                                              ROWS UNBOUNDED PRECEDING) AS committed_offset
          FROM (SELECT *, appended_at + to_hours(ingest_seq % 11) AS moment FROM feed WHERE ingest_seq % 5 = 2)) c
    ASOF JOIN (SELECT DISTINCT topic, record_partition, appended_at AS moment,
                      max(record_offset + 1) OVER (PARTITION BY topic, record_partition ORDER BY appended_at) AS end_offset
               FROM feed) e
      ON c.topic = e.topic AND c.record_partition = e.record_partition AND c.moment >= e.moment""", "feed"))
def lag_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag at every commit; every fifth record commits, up to ten hours after it came, some overtaken."""
    records = kept(
        with_offsets(feed_of(events(spark, sf_dir))).select(*PARTITION, "ingest_seq", "appended_at", "record_offset"), "log"
    )
    past = F.col("record_offset") + 1
    ends = records.select(*PARTITION, F.col("appended_at").alias("moment"), past.alias("end_offset"))
    commits = records.filter("ingest_seq % 5 = 2").select(
        *PARTITION,
        F.expr("appended_at + (ingest_seq % 11) * INTERVAL '1' HOUR").alias("moment"),
        F.col("ingest_seq").alias("seq"),
        past.alias("committed_offset"),
    )
    return lag_as_of(ends, commits)
