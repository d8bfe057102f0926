"""Decoding, de-duplication and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.buckets import latency_millis, minute_key, minute_of
from ledgerline.functions.payload import (
    ORDER,
    POISON,
    classify,
    classify_wire,
    envelope_ok,
    magic_byte,
    schema_id,
)
from ledgerline.operators.arrival import first_copies, orders_of, split_gate
from ledgerline.operators.revenue import (
    hot_counters,
    merged,
    orders_panel,
    per_minute,
    revenue_panel,
    totals,
)
from ledgerline.plans.registry import query
from ledgerline.plans.sqlparts import select
from ledgerline.sources.feed import order_feed

HALFWAY = "2024-01-16 00:00:00"
PANEL_TIME = "2024-01-20 12:00:00"


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(order_feed(spark, sf_dir))


def applied_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copy of every order; all columns fixed-width, so it is a hash aggregate."""
    return first_copies(
        orders_of(decoded(spark, sf_dir)), ["amount_cents", "produced_at", "latency_ms"]
    )


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_minute(applied_orders(spark, sf_dir))


def with_latency(applied: DataFrame) -> DataFrame:
    """Commit stamp and latency of each applied order."""
    committed = F.col("produced_at") + F.col("latency_ms")
    return applied.withColumn("committed_ms", committed).withColumn(
        "latency_ms", latency_millis(F.col("committed_ms"), F.col("produced_at"))
    )


@query("decode_kinds", select(
    "SELECT kind, reason, count(*) AS records FROM decoded GROUP BY kind, reason", "decoded"))
def decode_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(spark, sf_dir).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("records"))


@query("decode_events", select("""
    SELECT ingest_seq, order_id, customer_id, amount_cents, currency, item_count, produced_at,
           schema_version, promo_code FROM orders_in""", "orders_in"))
def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_of(decoded(spark, sf_dir)).select(
        "ingest_seq", "order_id", "customer_id", "amount_cents", "currency", "item_count",
        "produced_at", "schema_version", "promo_code",
    )


@query("envelope_check", select("""
    SELECT ingest_seq, kind,
           CASE WHEN length(wire) >= 2 THEN CAST('0x' || substr(wire, 1, 2) AS INTEGER) END
               AS magic_byte,
           CASE WHEN length(wire) >= 10 THEN CAST('0x' || substr(wire, 3, 8) AS BIGINT) END
               AS schema_id,
           coalesce(regexp_matches(wire, '^00(00000001|00000002)'), false) AS envelope_ok
    FROM (SELECT ingest_seq, kind,
                 CASE WHEN kind = 'order'
                      THEN CASE WHEN f_version = 'v1' THEN '0000000001' ELSE '0000000002' END
                           || hex(payload)
                      ELSE hex(payload) END AS wire FROM decoded)""", "decoded"))
def envelope_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("payload").cast("binary")
    head = F.when(F.col("schema_version") == "v1", F.unhex(F.lit("0000000001"))).otherwise(
        F.unhex(F.lit("0000000002"))
    )
    wire = F.when(F.col("kind") == ORDER, F.concat(head, body)).otherwise(body)
    return decoded(spark, sf_dir).withColumn("wire", wire).select(
        "ingest_seq",
        "kind",
        magic_byte(F.col("wire")).alias("magic_byte"),
        schema_id(F.col("wire")).alias("schema_id"),
        envelope_ok(F.col("wire"), (1, 2)).alias("envelope_ok"),
    )


@query("decode_wire", select("""
    SELECT CASE WHEN refused THEN 'poison' ELSE kind END AS kind,
           CASE WHEN refused THEN 'bad envelope' ELSE reason END AS reason, count(*) AS records
    FROM (SELECT *, payload IS NOT NULL AND ingest_seq % 50 IN (7, 17) AS refused FROM decoded)
    GROUP BY 1, 2""", "decoded"))
def decode_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in envelopes, some with a wrong magic byte or an unknown schema id."""
    seq = F.col("ingest_seq")
    head = (
        F.when(seq % 50 == 7, "0100000001").when(seq % 50 == 17, "0000000009")
        .when(F.col("appended_at") < F.expr(f"TIMESTAMP_NTZ '{HALFWAY}'"), "0000000001")
        .otherwise("0000000002")
    )
    wire = F.concat(F.unhex(head), F.col("payload").cast("binary"))
    sent = order_feed(spark, sf_dir).withColumn("wire", wire).drop("payload")
    kinds = classify_wire(sent, "wire", (1, 2))
    return kinds.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("records"))


@query("schema_audit", select("""
    SELECT coalesce(o.schema_version, 'unreadable') AS schema_version, count(*) AS records,
           count(o.order_id) AS readable,
           count(*) FILTER (o.currency_defaulted) AS currency_defaulted,
           count(*) FILTER (o.order_id IS NOT NULL AND o.promo_code IS NULL) AS promo_missing
    FROM decoded d LEFT JOIN orders_in o USING (ingest_seq)
    WHERE d.kind IN ('order', 'poison') GROUP BY 1""", "orders_in"))
def schema_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_order = F.col("kind") == ORDER
    return (
        decoded(spark, sf_dir)
        .filter(F.col("kind").isin(ORDER, POISON))
        .groupBy(F.coalesce("schema_version", F.lit("unreadable")).alias("schema_version"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(is_order).alias("readable"),
            F.count_if(F.col("currency_defaulted")).alias("currency_defaulted"),
            F.count_if(is_order & F.col("promo_code").isNull()).alias("promo_missing"),
        )
    )


@query("minute_keys", select("""
    SELECT minute, 'revenue:minute:' || strftime(minute, '%Y%m%dT%H%M') AS minute_key,
           count(*) AS records
    FROM (SELECT CAST(date_trunc('minute', make_timestamp(produced_at * 1000)) AS TIMESTAMP)
                 AS minute FROM orders_in) GROUP BY 1""", "orders_in"))
def minute_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        orders_of(decoded(spark, sf_dir))
        .groupBy(minute_of(F.col("produced_at")).alias("minute"))
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumn("minute_key", minute_key("revenue:minute", F.col("minute")))
    )


@query("first_arrival", select("""
    SELECT order_id, ingest_seq, copies, customer_id, amount_cents, produced_at, schema_version,
           record_partition FROM firsts""", "firsts"))
def first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_copies(
        orders_of(decoded(spark, sf_dir)),
        ["customer_id", "amount_cents", "produced_at", "schema_version", "record_partition"],
    )


@query("first_sight_gate", select(f"""
    SELECT ingest_seq, order_id,
           CAST(row_number() OVER (PARTITION BY order_id ORDER BY ingest_seq) = 1
                AND order_id NOT IN (SELECT order_id FROM orders_in
                                     WHERE appended_at < TIMESTAMP '{HALFWAY}') AS INTEGER) AS applied
    FROM orders_in WHERE appended_at >= TIMESTAMP '{HALFWAY}'""", "orders_in"))
def first_sight_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the feed is in the ledger; each record of the rest is judged."""
    orders = orders_of(decoded(spark, sf_dir)).select("ingest_seq", "order_id", "appended_at")
    return split_gate(orders, F.col("appended_at") < F.expr(f"TIMESTAMP_NTZ '{HALFWAY}'"))


@query("revenue_per_minute", select("""
    SELECT minute, order_count, total_cents, CAST(total_cents AS DOUBLE) / 100 AS revenue_usd
    FROM minutes ORDER BY minute""", "minutes"))
def revenue_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_panel(minutes(spark, sf_dir))


@query("orders_per_minute", select(
    "SELECT minute, order_count AS orders FROM minutes ORDER BY minute", "minutes"))
def orders_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_panel(minutes(spark, sf_dir))


@query("revenue_totals", select("""
    SELECT CAST(coalesce(sum(total_cents), 0) AS BIGINT) AS revenue_total_cents,
           CAST(coalesce(sum(order_count), 0) AS BIGINT) AS revenue_order_count
    FROM minutes""", "minutes"))
def revenue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(minutes(spark, sf_dir))


@query("revenue_merge", select(
    "SELECT minute, order_count, total_cents FROM minutes", "minutes"))
def revenue_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The increments of two batches that share minutes, added up."""
    applied = applied_orders(spark, sf_dir).withColumn("batch_id", F.col("ingest_seq") % 2)
    return merged(per_minute(applied, "batch_id"))


@query("recent_range", select(f"""
    SELECT minute, order_count, total_cents FROM minutes
    WHERE minute BETWEEN TIMESTAMP '{PANEL_TIME}' - INTERVAL 30 MINUTE
                     AND TIMESTAMP '{PANEL_TIME}'""", "minutes"))
def recent_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.expr(f"TIMESTAMP_NTZ '{PANEL_TIME}'")
    since = as_of - F.expr("INTERVAL 30 MINUTES")
    return minutes(spark, sf_dir).filter(F.col("minute").between(since, as_of))


@query("hot_counters", select(f"""
    SELECT 'revenue:total_cents' AS key, CAST(sum(amount_cents) AS BIGINT) AS value FROM firsts
    UNION ALL SELECT 'revenue:order_count', count(*) FROM firsts
    UNION ALL
    SELECT 'revenue:minute:' || strftime(minute, '%Y%m%dT%H%M') || ':cents',
           CAST(sum(amount_cents) AS BIGINT)
    FROM (SELECT *, CAST(date_trunc('minute', make_timestamp(produced_at * 1000)) AS TIMESTAMP)
                    AS minute FROM firsts)
    GROUP BY minute
    HAVING make_timestamp(max(produced_at + latency_ms) * 1000) + INTERVAL 2 HOUR
           > TIMESTAMP '{PANEL_TIME}'""", "firsts"))
def hot_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    applied = with_latency(applied_orders(spark, sf_dir))
    return hot_counters(applied, F.expr(f"TIMESTAMP_NTZ '{PANEL_TIME}'"))
