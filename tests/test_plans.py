"""What the plans must and must not contain, whatever the size of the tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.deadletter import latest
from ledgerline.plans import QUERIES
from ledgerline.session import clear_folders, kept, shared_folder
from ledgerline.sources.feed import order_feed

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name, scans", [
    ("revenue_per_minute", 1), ("decode_kinds", 1), ("first_arrival", 1), ("revenue_merge", 1),
    ("order_differences", 1), ("reconcile", 2),  # what was sent is counted at the source
])
def test_each_record_is_parsed_once(spark, name, scans):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert plan.count("from_json(") == 1 and plan.count("FileScan") == scans


def test_revenue_reads_four_columns_and_shuffles_partial_results(spark):
    plan = plan_of(QUERIES["revenue_per_minute"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def test_offsets_move_no_payload(spark):
    plan = plan_of(QUERIES["dlq_quarantine"](spark, SF_DIR))
    offsets = plan[plan.index("Window") :]
    assert "payload" not in offsets


def test_latest_is_a_top_k(spark):
    rows = order_feed(spark, SF_DIR).selectExpr("appended_at AS received_at", "ingest_seq AS id")
    assert "TakeOrderedAndProject" in plan_of(latest(rows))


def test_kept_results_lie_in_the_configured_folder_until_cleared(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder in shared_folder(spark)
    rows = kept(spark.range(3).select(F.col("id")), "three")
    file = rows.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert folder in file and rows.count() == 3 and Path(file).exists()
    clear_folders(spark)
    assert not Path(file).exists()
