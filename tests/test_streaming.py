"""The streams: redelivery, crashes, replay, compaction."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerline.operators import keyfilter
from ledgerline.schemas import LANDED
from ledgerline.session import streaming_session
from ledgerline.sources.landing import landed_stream
from ledgerline.streaming import apply, keyindex, metrics, outputs, replay

EPOCH = "1970-01-01 00:00:00"


def payload(order, cents, produced):
    return json.dumps({
        "orderId": order, "customerId": "c", "amountCents": cents, "itemCount": 1,
        "producedAt": produced, "schemaVersion": "v2",
    })


def record(seq, value):
    return (seq, "orders", 0, seq, f"k-{seq}", value)


def order(seq, key, cents, produced):
    return record(seq, payload(f"o-{key}", cents, produced))


def land(spark, path, records, at=EPOCH):
    """One file holding the records; files are taken up in the order they were landed."""
    rows = spark.createDataFrame(
        records, "ingest_seq long, topic string, record_partition int, record_offset long,"
        " record_key string, payload string",
    ).withColumn("appended_at", F.expr(f"TIMESTAMP_NTZ '{at}'"))
    rows.select(*LANDED.names).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def session(spark):
    return streaming_session(spark, state_partitions=2)


FORMS = {"state": apply.apply_orders, "gate": apply.apply_backfill}


def totals(spark, root):
    minutes = outputs.revenue_minutes(spark, root)
    return {
        (r.minute.hour * 60 + r.minute.minute): (r.order_count, r.total_cents)
        for r in minutes.collect()
    }


BATCHES = [
    [order(0, 1, 100, 0), record(1, "THIS-IS-NOT-AVRO"), order(2, 1, 900, 60_000)],
    [order(3, 2, 50, 0), order(4, 1, 800, 120_000), record(5, None)],
    [order(6, 3, 7, 120_000), order(7, 3, 8, 0), record(8, "")],
]
EXPECTED = {0: (2, 150), 2: (1, 7)}


@pytest.mark.parametrize("form", FORMS)
def test_orders_are_applied_once(spark, session, root, form):
    landing = f"{root}/landing"
    for records in BATCHES:
        land(session, landing, records)
        FORMS[form](session, landed_stream(session, landing), root).awaitTermination()
    assert totals(spark, root) == EXPECTED
    # Every batch is delivered a second time, one file per micro-batch.
    for records in BATCHES:
        land(session, landing, records)
    FORMS[form](session, landed_stream(session, landing, 1), root).awaitTermination()
    assert totals(spark, root) == EXPECTED
    ledger = outputs.read_table(spark, root, "ledger")
    assert ledger.count() == ledger.select("order_id").distinct().count() == 3
    first = ledger.filter("order_id = 'o-1'").first()
    assert (first.record_offset, first.amount_cents, first.topic) == (0, 100, "orders")


def test_lowest_arrival_of_the_first_batch_wins(spark, session, root):
    landing = f"{root}/landing"
    land(session, landing, [order(9, 1, 3, 0), order(8, 1, 2, 0)])
    land(session, landing, [order(0, 1, 1, 0)])
    apply.apply_orders(session, landed_stream(session, landing, 1), root).awaitTermination()
    assert outputs.read_table(spark, root, "ledger").first().amount_cents == 2


@pytest.mark.parametrize("form", FORMS)
def test_crash_between_ledger_and_increments(spark, session, root, form, monkeypatch):
    landing = f"{root}/landing"
    land(session, landing, BATCHES[0])
    FORMS[form](session, landed_stream(session, landing), root).awaitTermination()
    land(session, landing, BATCHES[1])

    def crash(*_):
        raise RuntimeError("executor gone")

    with monkeypatch.context() as patched:
        patched.setattr(apply, "commit_increments", crash)
        query = FORMS[form](session, landed_stream(session, landing), root)
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
    # The failed attempt left ledger rows behind: the batch had unseen orders.
    assert outputs.read_batch(spark, root, "ledger", 1).count() == 1
    assert totals(spark, root) == {0: (1, 100)}
    land(session, landing, BATCHES[2])
    FORMS[form](session, landed_stream(session, landing), root).awaitTermination()
    assert totals(spark, root) == EXPECTED


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 99), st.integers(0, 3)), min_size=4, max_size=12),
       st.integers(1, 3))
def test_any_split_gives_the_same_revenue(spark, tmp_path_factory, rows, parts):
    root = str(tmp_path_factory.mktemp("split"))
    session = streaming_session(spark, state_partitions=2)
    records = [order(i, k, c, m * 60_000) for i, (k, c, m) in enumerate(rows)]
    size = -(-len(records) // parts)
    for i in range(0, len(records), size):
        land(session, f"{root}/landing", records[i:i + size])
        apply.apply_orders(session, landed_stream(session, f"{root}/landing"), root).awaitTermination()
    expected, seen = {}, set()
    for key, cents, minute in rows:
        if key not in seen:
            seen.add(key)
            n, total = expected.get(minute, (0, 0))
            expected[minute] = (n + 1, total + cents)
    assert totals(spark, root) == expected


def test_quarantine_counts_and_replay(spark, session, root):
    landing = f"{root}/landing"
    for records in BATCHES:
        land(session, landing, records)

    def drain():
        apply.quarantine_records(landed_stream(session, landing, 1), root).awaitTermination()
        apply.apply_orders(session, landed_stream(session, landing, 1), root).awaitTermination()

    drain()
    dead = outputs.read_table(spark, root, "quarantine")
    assert {r.id: r.exception_message for r in dead.collect()} == {
        1: "Deserialization failed: malformed payload", 8: "Deserialization failed: empty payload",
    }
    counts = outputs.read_table(spark, root, "counts").agg(
        F.sum("consumed"), F.sum("orders"), F.sum("poison"), F.sum("tombstones")
    ).first()
    assert tuple(counts) == (9, 6, 2, 1)
    samples = metrics.counter_samples(spark, root).groupBy("name").agg(F.max("v").alias("v"))
    assert {r.name: r.v for r in samples.collect()} == {"orders_consumed": 9, "dlq_received": 2}

    # Both are sent again and come back under their new keys.
    assert replay.replay_all(session, root, landing, "r-1", 100) == 2
    drain()
    again = {r.id: r for r in replay.waiting(spark, root).collect()}
    assert set(again) == {101, 108}
    assert again[101].key_hint.startswith("replay-1-")
    assert totals(spark, root) == EXPECTED

    # Repaired payloads are applied once, however often they are sent.
    repaired = dead.limit(1).select(
        F.lit(1).cast("long").alias("id"), "source_topic", "source_partition", "source_offset",
        "dlq_partition", "key_hint", "exception_message",
        F.base64(F.lit(payload("o-9", 30, 0)).cast("binary")).alias("raw_base64"), "received_at",
    ).withColumn("id", F.lit(55).cast("long"))
    outputs.write_batch(repaired, root, "quarantine", 1_000)
    assert replay.replay_all(session, root, landing, "r-2", 1_000) == 3
    drain()
    land(session, landing, [order(5_000, 9, 31, 0)])
    drain()
    assert totals(spark, root) == {0: (3, 180), 2: (1, 7)}


def test_compaction_keeps_the_totals(spark, session, root):
    landing = f"{root}/landing"
    for records in BATCHES:
        land(session, landing, records)
    apply.apply_orders(session, landed_stream(session, landing, 1), root).awaitTermination()
    apply.quarantine_records(landed_stream(session, landing, 1), root).awaitTermination()
    for upto in (0, 1):
        for stream in ("orders", "quarantine"):
            outputs.compact(spark, root, stream, upto)
        assert totals(spark, root) == EXPECTED
        assert outputs.last_compacted(spark, root, "orders") == upto
        assert outputs.read_table(spark, root, "ledger").count() == 3
        assert outputs.read_table(spark, root, "quarantine").count() == 2
        assert outputs.read_table(spark, root, "counts").count() == 3
    land(session, landing, [order(50, 50, 1_000, 0)])
    apply.apply_orders(session, landed_stream(session, landing, 1), root).awaitTermination()
    assert totals(spark, root) == {0: (3, 1_150), 2: (1, 7)}
    latencies = outputs.committed_latency(spark, root)
    assert latencies.count() == 4 and latencies.filter("latency_ms <= 0").count() == 0


def test_gate_reads_compacted_batches(spark, session, root):
    landing = f"{root}/landing"
    for i, records in enumerate(BATCHES):
        land(session, landing, records)
        apply.apply_backfill(session, landed_stream(session, landing), root).awaitTermination()
        outputs.compact(spark, root, "orders", i)
    assert totals(spark, root) == EXPECTED


def test_lag_from_a_progress_report(spark):
    report = json.dumps({"sources": [{
        "endOffset": {"orders": {"0": 5, "1": 9}},
        "latestOffset": {"orders": {"0": 8, "1": 9, "2": 4}},
    }]})
    got = metrics.lag_from_progress(spark, report)
    assert {r.record_partition: r.lag for r in got.collect()} == {0: 3, 1: 0, 2: 4}


def test_a_repeated_replay_sends_nothing_twice(spark, session, root):
    landing = f"{root}/landing"
    land(session, landing, BATCHES[0])
    apply.quarantine_records(landed_stream(session, landing), root).awaitTermination()
    assert [replay.replay_all(session, root, landing, "r", 100) for _ in range(3)] == [1, 1, 1]
    apply.quarantine_records(landed_stream(session, landing), root).awaitTermination()
    # Under the used id the newly waiting one isn't sent, under another it is.
    assert replay.replay_all(session, root, landing, "r", 100) == 1
    assert {r.id for r in replay.waiting(spark, root).collect()} == {101}
    assert replay.replay_all(session, root, landing, "s", 1_000) == 1
    assert spark.read.schema(LANDED).parquet(landing).count() == len(BATCHES[0]) + 2


@pytest.mark.parametrize("step", ["landing", "log"])
def test_a_replay_that_broke_off_is_finished_by_the_next_call(spark, session, root, step, monkeypatch):
    landing = f"{root}/landing"
    land(session, landing, BATCHES[0])
    apply.quarantine_records(landed_stream(session, landing), root).awaitTermination()
    writer = type(spark.range(1).write)
    write = writer.parquet

    def crash(self, path, *args, **kwargs):
        if ("replay_log" if step == "log" else "landing") in path:
            raise RuntimeError("driver gone")
        return write(self, path, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(writer, "parquet", crash)
        with pytest.raises(RuntimeError):
            replay.replay_all(session, root, landing, "r", 100)
    assert replay.replay_all(session, root, landing, "r", 100) == 1
    assert spark.read.schema(LANDED).parquet(landing).count() == len(BATCHES[0]) + 1


def test_compaction_of_an_unfinished_batch_is_refused(spark, session, root):
    landing = f"{root}/landing"
    land(session, landing, BATCHES[0])
    apply.apply_orders(session, landed_stream(session, landing), root).awaitTermination()
    outputs.write_batch(outputs.read_batch(spark, root, "ledger", 0), root, "ledger", 7)
    for upto in (7, 8):
        with pytest.raises(ValueError):
            outputs.compact(spark, root, "orders", upto)
    outputs.compact(spark, root, "orders", 0)
    with pytest.raises(ValueError):
        outputs.compact(spark, root, "orders", 0)


def test_a_lost_batch_shows(spark, session, root):
    landing = f"{root}/landing"
    for records in BATCHES:
        land(session, landing, records)
    apply.apply_backfill(session, landed_stream(session, landing), root).awaitTermination()
    good = metrics.stream_balance(spark, root, landing).first()
    assert good.balanced and (good.produced, good.unique_orders, good.duplicates) == (9, 3, 3)
    outputs.write_batch(outputs.read_batch(spark, root, "counts", 1).filter("false"), root, "counts", 1)
    outputs.write_batch(outputs.read_batch(spark, root, "quarantine", 2).filter("false"), root, "quarantine", 2)
    bad = metrics.stream_balance(spark, root, landing).first()
    assert not bad.balanced and bad.lost == 3 and bad.missing == 1


def test_lost_ledger_rows_show(spark, session, root):
    """Orders taken in but gone from the ledger are missing, not duplicates."""
    landing = f"{root}/landing"
    for i in range(3):
        land(session, landing, [order(10 * i + k, 10 * i + k, 100, 0) for k in range(5)] + [order(900 + i, 0, 1, 0)])
    apply.apply_backfill(session, landed_stream(session, landing), root).awaitTermination()
    good = metrics.stream_balance(spark, root, landing).first()
    assert good.balanced and (good.unique_orders, good.duplicates, good.missing) == (15, 3, 0)
    some = outputs.read_batch(spark, root, "ledger", 0)
    gone = [r.order_id for r in some.orderBy("order_id").limit(3).collect()]
    outputs.write_batch(some.filter(~F.col("order_id").isin(gone)).checkpoint(), root, "ledger", 0)
    bad = metrics.stream_balance(spark, root, landing).first()
    assert (bad.lost, bad.missing, bad.duplicates, bad.balanced) == (0, 3, 3, False)
    assert sorted(r.key for r in metrics.missing_rows(spark, root, landing).collect()) == gone
    # a whole batch
    outputs.write_batch(outputs.read_batch(spark, root, "ledger", 2).filter("false"), root, "ledger", 2)
    bad = metrics.stream_balance(spark, root, landing).first()
    assert (bad.missing, bad.balanced) == (8, False)
    # an order that nobody sent, one that was applied twice
    extra = outputs.read_batch(spark, root, "ledger", 1).limit(1)
    outputs.write_batch(extra.union(extra.withColumn("order_id", F.lit("o-x"))).checkpoint(), root, "ledger", 2)
    bad = metrics.stream_balance(spark, root, landing).first()
    assert (bad.unknown, bad.repeated, bad.balanced) == (1, 1, False)


def test_a_clock_set_back_stops_the_stream(spark, session, root):
    landing = f"{root}/landing"
    land(session, landing, BATCHES[0])
    apply.apply_orders(session, landed_stream(session, landing), root).awaitTermination()
    late = spark.range(1).select(F.expr("unix_millis(current_timestamp()) + 3600000").alias("committed_at"))
    outputs.write_batch(late, root, "commits", 0)
    land(session, landing, BATCHES[1])
    query = apply.apply_orders(session, landed_stream(session, landing), root)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def test_bounded_state_applies_copies_within_the_horizon_once(spark, session, root):
    landing = f"{root}/landing"
    for i, records in enumerate(BATCHES):
        land(session, landing, records, f"2024-01-01 0{i}:00:00")
    apply.apply_bounded(session, landed_stream(session, landing), root).awaitTermination()
    assert sorted(r.order_id for r in outputs.read_table(spark, root, "ledger").collect()) == ["o-1", "o-2", "o-3"]


@pytest.mark.parametrize("partitions", ["4", "200"])
def test_ledger_rows_at_any_number_of_partitions(spark, session, root, partitions):
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    landing = f"{root}/landing"
    land(session, landing, BATCHES[0])
    apply.apply_orders(session, landed_stream(session, landing), root).awaitTermination()
    assert totals(spark, root) == {0: (1, 100)}
    outputs.compact(spark, root, "orders", 0)
    assert totals(spark, root) == {0: (1, 100)}


def test_late_first_copies_are_applied_and_listed(spark, session, root):
    landing = f"{root}/landing"
    days = [("10", [order(0, 1, 100, 0)]), ("11", [order(1, 2, 10, 0)]), ("02", [order(2, 3, 5, 0), order(3, 1, 9, 0)]),
            ("02", [order(4, 3, 6, 0), order(5, 4, 7, 0)]), ("12", [order(6, 2, 8, 0)])]
    for day, records in days:
        land(session, landing, records, f"2024-01-{day} 00:00:00")
    apply.apply_bounded(session, landed_stream(session, landing), root, "1 day").awaitTermination()
    ledger = {r.order_id: r.amount_cents for r in outputs.read_table(spark, root, "ledger").collect()}
    assert ledger == {"o-1": 100, "o-2": 10, "o-3": 5, "o-4": 7}
    late = {(r.order_id, r.batch_id): r.applied for r in outputs.read_table(spark, root, "late").collect()}
    assert late == {("o-3", 2): True, ("o-1", 2): False, ("o-3", 3): False, ("o-4", 3): True}
    outputs.compact(spark, root, "orders", 4)
    land(session, landing, [order(7, 3, 1, 0), order(8, 9, 2, 0)], "2024-01-02 00:00:00")
    apply.apply_bounded(session, landed_stream(session, landing), root, "1 day").awaitTermination()
    assert totals(spark, root) == {0: (5, 124)}


def test_batches_before_the_horizon_are_not_looked_at(spark, session, root):
    landing = f"{root}/landing"
    for i in range(5):
        land(session, landing, [order(i, i, 1, 0)], f"2024-01-{10 + 5 * i} 00:00:00")
    apply.apply_bounded(session, landed_stream(session, landing), root, "1 day").awaitTermination()
    assert apply.recent_batches(spark, root, 5, "1 day")[1] == {4}
    assert apply.recent_batches(spark, root, 5, "6 days")[1] == {2, 3, 4}


def test_the_gate_scans_folders_that_may_hold_a_key_and_no_others(spark, session, root):
    landing = f"{root}/landing"
    for i in range(8):
        land(session, landing, [order(100 * i + k, 100 * i + k, 1, 0) for k in range(60)])
    apply.apply_backfill(session, landed_stream(session, landing), root).awaitTermination()
    keys = spark.createDataFrame([("o-205",), ("o-700",), ("new",)], "order_id string")
    folders = keyindex.candidate_folders(spark, root, keys, 8)
    assert folders == [2, 7]
    assert keyindex.candidate_folders(spark, root, keys, 7) == [2]
    rows = keyindex.keys_in(spark, root, folders)
    assert {f.split("batch_id=")[1].split("/")[0] for f in rows.inputFiles()} >= {"2", "7"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch_id" in plan and rows.count() == 120
    # a folder without a filter may hold anything; compacted folders share one filter
    outputs.write_batch(outputs.read_batch(spark, root, "filters", 3).filter("false"), root, "filters", 3)
    assert keyindex.candidate_folders(spark, root, keys, 8) == [2, 3, 7]
    outputs.compact(spark, root, "orders", 5)
    assert keyindex.candidate_folders(spark, root, keys, 8) == [5, 7]
    assert keyindex.unheld(spark, root, keys, 8).collect()[0].order_id == "new"


def test_filters_pass_few_other_keys(spark):
    sets = spark.range(40_000).selectExpr("concat('a-', id) AS order_id", "id % 3 AS batch_id")
    words = keyfilter.filter_words(sets.union(spark.sql("SELECT 'one', 9L"))).cache()
    sizes = {r.size_bits for r in words.select("size_bits").distinct().collect()}
    inside = keyfilter.possible(sets.select("order_id"), words, sizes).filter("batch_id < 3")
    assert inside.join(sets, ["order_id", "batch_id"]).count() == 40_000
    others = spark.range(100_000).selectExpr("concat('b-', id) AS order_id")
    assert keyfilter.possible(others, words, sizes).count() < 40
    words.unpersist()
