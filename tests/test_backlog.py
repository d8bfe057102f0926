"""How a feed of any size is landed and taken up."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import differences
from ledgerline.plans import ORACLES, QUERIES, streams
from ledgerline.schemas import LANDED
from ledgerline.session import streaming_session
from ledgerline.sources import landing
from ledgerline.sources.feed import order_feed, with_offsets
from ledgerline.sources.landing import landed_stream
from ledgerline.streaming import apply, replay

ROWS, FILE_ROWS = 400, 20


@pytest.fixture
def sf_dir(spark, tmp_path, monkeypatch):
    """A folder with events of ten days, landed as files of few rows."""
    monkeypatch.setattr(landing, "FILE_ROWS", FILE_ROWS)
    spark.range(ROWS).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-10' + make_dt_interval(0, 0, 36 * int(id)) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "double(id % 50) AS value", "string(null) AS props",
    ).coalesce(1).write.parquet(f"{tmp_path}/sf/events.parquet/data")
    (file,) = Path(f"{tmp_path}/sf/events.parquet/data").glob("*.parquet")
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat/events.parquet").write_bytes(file.read_bytes())
    return f"{tmp_path}/flat"


@pytest.mark.parametrize("name", ["stream_latency", "stream_repaired"])
def test_a_backlog_of_many_files_gives_the_same_rows(spark, sf_dir, name):
    # stream_latency counts its commits: four, however many files there are
    assert not differences(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)


@pytest.mark.parametrize("drains, swapped", [(1, False), (2, False), (1, True)])
def test_files_are_bounded_in_order_and_read_one_piece_each(spark, sf_dir, root, monkeypatch, drains, swapped):
    spans, plans, calls, append = [], [], [], streams.append

    def watched(records, path):
        spans.append(records.agg(F.min("ingest_seq"), F.max("ingest_seq"), F.count(F.lit(1))).first())
        plans.append(records._jdf.queryExecution().executedPlan().toString())
        append(records, path)

    monkeypatch.setattr(streams, "append", watched)
    session = streaming_session(spark, state_partitions=2)
    past, files = streams.land_and_drain(session, sf_dir, f"{root}/landing", calls.append, drains, swapped)
    assert past == ROWS and calls == [files] * drains
    assert len(spans) == files * drains * streams.BATCHES
    assert all(n <= FILE_ROWS and hi - lo + 1 == n for lo, hi, n in spans)
    quarters = [i * 4 // len(spans) for i in range(len(spans))]
    turns = {0: 0, 1: 2, 2: 1, 3: 3} if swapped else {q: q for q in range(4)}
    assert [lo * 4 // ROWS for lo, _, _ in spans] == [turns[q] for q in quarters]
    assert all("PartitionFilters: [isnotnull(piece" in plan for plan in plans)


def test_of_records_that_share_a_position_the_largest_offset_is_applied(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.union(events).coalesce(1).write.parquet(f"{sf_dir}/twice/events.parquet")
    numbered = with_offsets(order_feed(spark, f"{sf_dir}/twice")).select("ingest_seq", "record_partition", "record_offset")
    largest = {r[:2]: r.last for r in numbered.groupBy("ingest_seq", "record_partition").agg(F.max("record_offset").alias("last")).collect()}
    applied = QUERIES["stream_ledger"](spark, f"{sf_dir}/twice").collect()
    found = {int(r.order_id.removeprefix("ord-")): (r.record_partition, r.record_offset) for r in applied}
    # an order whose first record is unreadable is applied from its other one, three positions later
    assert found and all(o in {largest.get((k, p)), largest.get((k + 3, p))} for k, (p, o) in found.items())


def test_a_replay_lands_as_few_files(spark, root):
    session = streaming_session(spark, state_partitions=2)
    rows = session.range(40).selectExpr(
        "id AS ingest_seq", "'orders' AS topic", "0 AS record_partition", "id AS record_offset",
        "concat('k-', id) AS record_key", "timestamp_ntz'2024-01-10' AS appended_at", "'garbage' AS payload",
    )
    for part in range(4):
        landing.append(rows.filter(F.col("ingest_seq") % 4 == part), f"{root}/landing")
    apply.apply_backfill(session, landed_stream(session, f"{root}/landing"), root).awaitTermination()
    before = set(Path(f"{root}/landing").glob("*.parquet"))
    assert replay.replay_all(session, root, f"{root}/landing", "r", 40) == 40
    assert len(set(Path(f"{root}/landing").glob("*.parquet")) - before) == 1
    assert spark.read.schema(LANDED).parquet(f"{root}/landing").filter("ingest_seq >= 40").count() == 40
