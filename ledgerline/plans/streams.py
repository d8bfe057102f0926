"""Streaming jobs run to the end of their input; their results equal the batch ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.reconcile import one_row
from ledgerline.operators.revenue import revenue_panel
from ledgerline.plans.deadletters import published
from ledgerline.plans.registry import query
from ledgerline.plans.sqlparts import select
from ledgerline.schemas import DEAD_LETTER
from ledgerline.session import fresh_folder, kept, streaming_session
from ledgerline.sources.feed import offsets_of, order_feed, with_offsets
from ledgerline.sources.landing import FILES_PER_BATCH, append, files_for, landed_stream
from ledgerline.streaming.apply import (
    apply_backfill,
    apply_bounded,
    apply_orders,
    quarantine_records,
    quarantine_topic,
)
from ledgerline.streaming.metrics import counter_samples, stream_balance
from ledgerline.streaming.outputs import (
    committed_latency,
    read_replay_log,
    read_table,
    revenue_minutes,
)
from ledgerline.streaming.replay import replay_all, waiting

BATCHES = 4  # micro-batches that a run of a stream takes the feed up in, whatever its size
PIECES = 4  # of the dead-letter topic


def land_and_drain(
    spark: SparkSession, sf_dir: str, landing: str, drain: Callable[[int], None], drains: int = 1,
    swapped: bool = False,
) -> tuple[int, int]:
    """Land the feed piece by piece and run the stream after every few.

    Gives one past its positions and the files of a micro-batch, which ``drain`` is called with.  A piece
    is a bounded file.  A backlog is taken up in a fixed number of micro-batches of as many files as that
    takes: what a micro-batch costs whatever its size, and a look back at the earlier ones, is paid so many
    times and not once for each file.  The feed is dealt to its pieces once; a piece reads no other's records.
    Each run resumes from the checkpoint of the one before it.  ``swapped`` lands the third quarter
    of the feed before the second, which is late then.
    """
    feed = order_feed(spark, sf_dir)
    offsets = kept(offsets_of(feed), "offsets")
    lo, hi, n = offsets.agg(F.min("ingest_seq"), F.max("ingest_seq"), F.count(F.lit(1))).first()
    if lo is None:
        lo = hi = 0
    files = files_for(-(-n // (drains * BATCHES)))
    pieces = drains * BATCHES * files
    piece = F.expr(f"int(((ingest_seq - {lo} + 1) * {pieces} - 1) div {hi + 1 - lo})")
    dealt = with_offsets(feed, offsets).withColumn("piece", piece).repartition(pieces, "piece")
    # of records that share a position the gate takes the last it reads
    dealt = dealt.sortWithinPartitions("piece", "ingest_seq", "record_offset")
    dealt = kept(dealt, "feed", by="piece")
    turns = list(range(pieces))
    if swapped:
        a, b, c = (pieces * q // 4 for q in (1, 2, 3))
        turns = turns[:a] + turns[b:c] + turns[a:b] + turns[c:]
    for done, i in enumerate(turns, 1):
        append(dealt.filter(F.col("piece") == i), landing)
        if done % (pieces // drains) == 0:
            drain(files)
    return hi + 1, files


def _run(spark: SparkSession, sf_dir: str, label: str, start, drains: int = 1, swapped: bool = False) -> str:
    session = streaming_session(spark)
    root = fresh_folder(spark, label)
    landing = f"{root}/landing"
    land_and_drain(
        session,
        sf_dir,
        landing,
        lambda files: start(session, landed_stream(session, landing, files), root).awaitTermination(),
        drains,
        swapped,
    )
    return root


@query("stream_revenue", select("""
    SELECT minute, order_count, total_cents, CAST(total_cents AS DOUBLE) / 100 AS revenue_usd
    FROM minutes""", "minutes"))
def stream_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed state: the stream's revenue table, over two runs."""
    root = _run(spark, sf_dir, "revenue", apply_orders, drains=2)
    return revenue_panel(revenue_minutes(spark, root))


@query("stream_ledger", select("""
    SELECT order_id, topic, record_partition, record_offset, amount_cents, produced_at
    FROM firsts""", "firsts"))
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger gate: the rows applied, with the coordinates of each first copy."""
    root = _run(spark, sf_dir, "ledger", apply_backfill)
    return read_table(spark, root, "ledger").drop("processed_at", "batch_id")


@query("stream_quarantine", select("SELECT * EXCLUDE replayed FROM quarantine", "quarantine"))
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(
        spark, sf_dir, "quarantine", lambda _, records, root: quarantine_records(records, root)
    )
    return read_table(spark, root, "quarantine").drop("batch_id")


@query("stream_dead_letters", select("""
    SELECT q.* EXCLUDE (replayed, source_topic, exception_message),
           CASE WHEN id % 9 = 0 THEN 'orders.dlq' ELSE 'orders' END AS source_topic,
           left(coalesce(CASE WHEN id % 3 <> 0
                         THEN exception_message
                              || CASE WHEN id % 100 = 63 THEN repeat('x', 2100) ELSE '' END END,
                         CASE WHEN id % 9 <> 0
                         THEN 'trace: ' || replace(exception_message, 'Deserialization failed: ', '') END,
                         'unknown'), 2000) AS exception_message
    FROM quarantine q""", "quarantine"))
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead-letter topic as a stream: key, headers and bytes to quarantine rows."""
    session = streaming_session(spark)
    root = fresh_folder(spark, "dead-letters")
    topic = kept(published(session, sf_dir), "published")
    for part in range(PIECES):
        rows = topic.filter(F.col("id") % PIECES == part)
        rows.write.mode("append").parquet(f"{root}/topic")
    reader = session.readStream.schema(DEAD_LETTER).option("maxFilesPerTrigger", FILES_PER_BATCH)
    quarantine_topic(reader.parquet(f"{root}/topic"), root).awaitTermination()
    return read_table(spark, root, "quarantine").drop("batch_id")


@query("stream_counts", select("""
    SELECT CAST(count(*) AS BIGINT) AS consumed,
           count(*) FILTER (kind = 'order') AS orders,
           count(*) FILTER (kind = 'poison') AS poison,
           count(*) FILTER (kind = 'tombstone') AS tombstones,
           CAST(0 AS BIGINT) AS unexpected FROM decoded""", "decoded"))
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intake counters, added up over the micro-batches."""
    root = _run(
        spark, sf_dir, "counts", lambda _, records, root: quarantine_records(records, root)
    )
    counts = read_table(spark, root, "counts").drop("batch_id", "counted_at")
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns])


@query("stream_reconcile", select("""
    SELECT *, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS unknown,
           CAST(0 AS BIGINT) AS repeated, true AS balanced FROM (
        SELECT count(*) AS produced, count(*) AS consumed,
               count(DISTINCT order_id) AS unique_orders,
               count(order_id) - count(DISTINCT order_id) AS duplicates,
               count(*) FILTER (kind = 'poison') AS quarantined,
               count(*) FILTER (kind = 'tombstone') AS tombstones,
               CAST(0 AS BIGINT) AS unexpected FROM decoded)""", "decoded"))
def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records against what the stream's own outputs hold."""
    root = _run(spark, sf_dir, "reconcile", apply_backfill)
    return stream_balance(spark, root, f"{root}/landing")


# The quarters of the feed by position; the third one is landed before the second.
_QUARTERS = """
    (SELECT *, CASE WHEN ingest_seq - lo >= n * 3 // 4 THEN 3 WHEN ingest_seq - lo >= n * 2 // 4 THEN 1
                    WHEN ingest_seq - lo >= n // 4 THEN 2 ELSE 0 END AS turn
     FROM orders_in, (SELECT min(ingest_seq) AS lo, max(ingest_seq) + 1 - min(ingest_seq) AS n FROM feed))"""


@query("stream_bounded", select(f"""
    SELECT order_id, record_partition, record_offset, amount_cents, turn = 2 AS late FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY turn, ingest_seq) AS copy FROM {_QUARTERS})
    WHERE copy = 1""", "orders_in"))
def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders applied with a look-back of a day; a quarter of the feed comes days late, and is applied too."""
    root = _run(spark, sf_dir, "bounded", lambda s, r, at: apply_bounded(s, r, at, "1 day"), swapped=True)
    late = read_table(spark, root, "late").filter("applied").select("order_id", F.lit(True).alias("late"))
    ledger = read_table(spark, root, "ledger").join(late, "order_id", "left")
    return ledger.select(
        "order_id", "record_partition", "record_offset", "amount_cents", F.coalesce("late", F.lit(False)).alias("late")
    )


@query("stream_samples", select("""
    SELECT 'orders_consumed' AS name, CAST(count(*) AS BIGINT) AS v FROM decoded
    UNION ALL SELECT 'dlq_received', count(*) FILTER (kind = 'poison') FROM decoded""", "decoded"))
def stream_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live counters' last samples."""
    root = _run(
        spark, sf_dir, "samples", lambda _, records, root: quarantine_records(records, root)
    )
    return counter_samples(spark, root).groupBy("name").agg(F.max("v").alias("v"))


@query("stream_latency", select("""
    SELECT count(*) AS orders, CAST(0 AS BIGINT) AS negative, CAST(4 AS BIGINT) AS commits
    FROM firsts""", "firsts"))
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit latencies of the applied orders: how many, how many negative, over how many commits."""
    root = _run(spark, sf_dir, "commit-latency", apply_orders)
    commits = read_table(spark, root, "commits")
    # the stream may close with a batch without data, for its state's sake
    with_orders = read_table(spark, root, "ledger").select("batch_id").distinct()
    return one_row(
        committed_latency(spark, root).agg(
            F.count(F.lit(1)).alias("orders"), F.count_if(F.col("latency_ms") < 0).alias("negative")
        ),
        commits.join(with_orders, "batch_id").agg(F.count(F.lit(1)).alias("commits")),
    )


def dead_letters_landed(spark: SparkSession, sf_dir: str, label: str):
    """A landed feed, its dead letters quarantined: session, root, landing, drain, next position."""
    session = streaming_session(spark)
    root = fresh_folder(spark, label)
    landing = f"{root}/landing"

    def drain(files: int) -> None:
        apply_backfill(session, landed_stream(session, landing, files), root).awaitTermination()

    past, files = land_and_drain(session, sf_dir, landing, drain)
    return session, root, landing, lambda: drain(files), past


@query("stream_replay", select("""
    SELECT 2 * count(*) AS quarantined, count(*) AS replayed, count(*) AS pending
    FROM quarantine""", "quarantine"))
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dead letter is sent again, the call repeated; all are still bad, so all come back."""
    session, root, landing, drain, past = dead_letters_landed(spark, sf_dir, "replay")
    for _ in range(2):
        replay_all(session, root, landing, "replay-1", past)
    drain()
    replay_all(session, root, landing, "replay-1", past)

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias(name))

    return one_row(
        counted(read_table(spark, root, "quarantine"), "quarantined"),
        counted(read_replay_log(spark, root), "replayed"),
        counted(waiting(spark, root), "pending"),
    )


@query("stream_repaired", select("""
    SELECT f.orders + r.repaired AS orders, f.cents + 100 * r.repaired AS total_cents
    FROM (SELECT count(*) AS orders, CAST(sum(amount_cents) AS BIGINT) AS cents FROM firsts) f,
         (SELECT count(*) AS repaired FROM decoded
          WHERE kind = 'poison' AND payload LIKE '%"amountCents":"abc"%') r""", "firsts"))
def stream_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters with an unreadable amount are repaired and sent twice; each counts once."""
    session, root, landing, drain, past = dead_letters_landed(spark, sf_dir, "repaired")
    repair = F.regexp_replace("payload", '"amountCents":"abc"', '"amountCents":100')
    for replay_id, base in (("repair-1", past), ("repair-2", 10 * past)):
        replay_all(session, root, landing, replay_id, base, repair)
        drain()
    return read_table(spark, root, "ledger").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount_cents").alias("total_cents")
    )
