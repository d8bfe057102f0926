"""Loss found through digests: the exact orders, and only the rows of differing ranges."""

import random

import pytest

from ledgerline.operators import loss
from ledgerline.plans import audits
from ledgerline.streaming import keyindex, outputs

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = "order_id string, record_partition int, record_offset long, note string"


def rows_of(n, partitions=3):
    return [(f"o-{i}", i % partitions, i // partitions * 2, "n") for i in range(n)]


def written(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).repartitionByRange(4, "record_partition", "record_offset").sortWithinPartitions(
        "record_partition", "record_offset"
    ).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.mark.parametrize("fan, leaf", [(2, 8), (16, 64)])
def test_lost_and_unsent_orders_are_named(spark, root, fan, leaf):
    rng = random.Random(fan)
    rows = rows_of(1500)
    gone = set(rng.sample(range(1500), 4)) | set(range(700, 720))
    kept_rows = [r for i, r in enumerate(rows) if i not in gone]
    moved = kept_rows.pop(5)  # another order at its place
    ghost = ("ghost", *moved[1:])
    sent, held = written(spark, f"{root}/a", rows), written(spark, f"{root}/b", [*kept_rows, ghost])
    found, orders = loss.find_loss(sent, held, leaf, fan)
    got = {(r.order_id, r.verdict) for r in orders.collect()}
    assert got == {(rows[i][0], "lost") for i in gone} | {(moved[0], "lost"), ("ghost", "unsent")}
    touched = {(rows[i][1], rows[i][2] // leaf) for i in gone} | {(moved[1], moved[2] // leaf)}
    assert {(r.record_partition, r.range) for r in found.collect()} == touched
    assert sum(r.about_missing for r in found.collect()) == len(gone) + 1
    assert sum(r.sent - r.held for r in found.collect()) == len(gone)


def test_equal_sets_and_empty_ones(spark, root):
    sent = written(spark, f"{root}/a", rows_of(300))
    assert [x.count() for x in loss.find_loss(sent, sent)] == [0, 0]
    none = sent.filter("false")
    found, orders = loss.find_loss(sent, none)
    assert orders.filter("verdict = 'lost'").count() == 300 and found.agg({"about_missing": "sum"}).first()[0] == 300
    assert loss.find_loss(none, none)[1].count() == 0
    assert {r.verdict for r in loss.find_loss(none, sent)[1].collect()} == {"unsent"}


def test_a_swap_of_two_orders_shows_though_counts_and_sets_agree(spark, root):
    rows = rows_of(600)
    a, b = rows[100], rows[103]  # one partition, other places
    swapped = [r for r in rows if r not in (a, b)] + [(a[0], *b[1:]), (b[0], *a[1:])]
    sent, held = written(spark, f"{root}/a", rows), written(spark, f"{root}/b", swapped)
    assert loss.find_loss(sent, held)[1].count() == 4


def test_rows_outside_the_differing_ranges_are_not_read(spark, root):
    rows = rows_of(6000)
    sent, held = written(spark, f"{root}/a", rows), written(spark, f"{root}/b", [r for i, r in enumerate(rows) if i != 3000])
    found, orders = loss.find_loss(sent, held)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = orders._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "order_id" in line]
    assert len(scans) == 2 and "note" not in plan
    for scan in scans:
        filters = scan[scan.index("PushedFilters") :]
        assert all(f in filters for f in ("EqualTo(record_partition,0)", "GreaterThanOrEqual(record_offset,", "LessThan(record_offset,"))
    assert found.count() == 1


def test_height_reaches_one_range():
    assert [loss.height_for(x, 64, 16) for x in (None, 0, 63, 64, 1023, 1024, 10**9)] == [1, 1, 1, 2, 2, 3, 7]


def test_few_folders_of_a_dated_ledger_are_scanned(spark):
    from pyspark.sql import functions as F

    orders = audits.decoded(spark, SF_DIR).filter("kind = 'order'").select("ingest_seq", "order_id", "appended_at")
    root = audits._dated_ledger(spark, orders.filter(f"appended_at < TIMESTAMP_NTZ '{audits.HALFWAY}'"))
    batch = orders.filter(f"appended_at >= TIMESTAMP_NTZ '{audits.HALFWAY}'").select("order_id").distinct()
    folders = keyindex.candidate_folders(spark, root, batch, 100)
    assert len(outputs.read_table(spark, root, "commits").collect()) == 15 and len(folders) <= 2
    rows = keyindex.keys_in(spark, root, folders).union(keyindex.keys_in(spark, root, [3]))
    day = {r.batch_id for r in outputs.read_table(spark, root, "ledger").select(F.col("batch_id")).distinct().collect()}
    assert day == set(range(15)) and rows.count() < outputs.read_table(spark, root, "ledger").count() / 3
