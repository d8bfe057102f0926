"""Alert stretches of a stream, chains of replays and stored sketches, against brute force."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import lineage, sketches
from ledgerline.schemas import EVALUATIONS, Rule
from ledgerline.session import streaming_session
from ledgerline.streaming import alerts

RULE = Rule("Over", "warning", 5, hold_s=45, step_s=15)
START = datetime(2024, 1, 1, 23, 55, tzinfo=timezone.utc)


def at(tick):
    return START + timedelta(seconds=15 * tick)


def brute_stretches(values, last):
    """(since, until) of runs of true ticks that are over by the last tick's watermark, a minute back."""
    true = sorted(t for t, v in values.items() if v is not None and v > 5)
    runs = []
    for t in true:
        if runs and t - runs[-1][1] == 1:
            runs[-1][1] = t
        else:
            runs.append([t, t])
    return {(a, b): 15 * (b - a) >= 45 for a, b in runs if 15 * b + 22.5 <= 15 * last - 60}


@pytest.mark.parametrize("seed", [1, 2])
def test_closed_stretches_over_several_runs(spark, root, seed):
    rng = random.Random(seed)
    values, level = {}, 0
    for t in range(160):
        level = rng.choice([0, 9]) if rng.random() < 0.3 else level
        if rng.random() > 0.04:  # else a tick without an evaluation
            values[t] = None if rng.random() < 0.04 else float(level)
    session = streaming_session(spark, 2)
    for first, past in ((0, 50), (50, 51), (51, 160)):
        rows = [("Over", at(t), v) for t, v in values.items() if first <= t < past]
        rows += rows[:3]  # a repeated evaluation counts once
        rows.append((None, at(first), 9.0))
        spark.createDataFrame(rows, EVALUATIONS).write.mode("append").parquet(f"{root}/in")
        alerts.watch(session, f"{root}/in", root, RULE).awaitTermination()
    got = {}
    for r in alerts.read_stretches(spark, root).collect():
        since, until = ((x.astimezone(timezone.utc) - START).total_seconds() // 15 for x in (r.since, r.until))
        got[(since, until)] = r.fired
        assert r.ticks == until - since + 1 and r.severity == "warning"
    assert got == brute_stretches(values, max(values))


def test_a_stretch_stays_open_until_a_later_evaluation(spark, root):
    session = streaming_session(spark, 2)
    for rows, closed in (([("Over", at(t), 9.0) for t in range(9)], 0), ([("Over", at(20), 0.0)], 1)):
        spark.createDataFrame(rows, EVALUATIONS).write.mode("append").parquet(f"{root}/in")
        alerts.watch(session, f"{root}/in", root, RULE).awaitTermination()
        assert alerts.read_stretches(spark, root).count() == closed


def brute_lineage(dead, log, arrived, applied, good):
    first = {}
    for seq, key in arrived:
        first[key] = min(seq, first.get(key, seq))
    nexts = {}
    for i, key in set(log):
        nexts.setdefault(i, []).append(first.get(key))
    led = {n for ends in nexts.values() for n in ends}
    result = {}
    for root in set(dead) - led:
        level, ends, replays, depth, ids = [root], [], 0, 0, [root]
        while level:
            ends += [i for i in level if i not in nexts]
            level = [n for i in level if i in nexts for n in nexts[i]]
            replays += len(level)
            depth += bool(level)
            ids += [i for i in level if i is not None]
        ranks = [1 if i in applied else 2 if i in good else 3 if i in dead else 4 if i is None else 5 for i in ends]
        names = [lineage.APPLIED, lineage.REPEATED, lineage.WAITING, lineage.IN_FLIGHT, lineage.DROPPED]
        result[root] = (replays, depth, max(ids), names[min(ranks) - 1])
    return result


@pytest.mark.parametrize("seed", range(3))
def test_chains_of_replays(spark, seed):
    rng = random.Random(seed)
    dead, log, arrived, applied, good = list(range(20)), [], [], set(), set()
    seq, level = 100, list(range(20))
    for turn in range(4):
        came_back = []
        for i in level:
            for copy in range(rng.choice([0, 1, 1, 2])):
                key = f"replay-{i}-{turn}-{copy}"
                log += [(i, key)] * rng.choice([1, 2])
                fate = rng.choice(["applied", "repeated", "dead", "dead", "lost", "dropped"])
                if fate == "lost":
                    continue
                arrived += [(seq, key)] + [(seq + 5_000, key)] * rng.choice([0, 1])
                if fate == "dead":
                    dead.append(seq)
                    came_back.append(seq)
                if fate in ("applied", "repeated"):
                    good.add(seq)
                if fate == "applied":
                    applied.add(seq)
                seq += 1
        level = came_back
    frame = spark.createDataFrame
    one = "ingest_seq long"
    links = lineage.replay_links(frame(log, "id long, replay_key string"), frame(arrived, "ingest_seq long, record_key string"))
    rows = lineage.lineage(
        frame([(i,) for i in dead + dead[:2]], "id long"), links,
        frame([(i,) for i in applied], one), frame([(i,) for i in good], one),
    ).collect()
    got = {r.original: (r.replays, r.depth, r.last_id, r.outcome) for r in rows}
    assert len(rows) == len(got) and got == brute_lineage(dead, log, arrived, applied, good)


def test_chains_of_nothing(spark):
    none, one = spark.createDataFrame([], "id long"), "ingest_seq long"
    empty = spark.createDataFrame([], one)
    links = lineage.replay_links(
        spark.createDataFrame([], "id long, replay_key string"), spark.createDataFrame([], "ingest_seq long, record_key string")
    )
    assert lineage.lineage(none, links, empty, empty).count() == 0
    loop = spark.createDataFrame([(5, "k")], "id long, replay_key string")
    back = spark.createDataFrame([(3, "k")], "ingest_seq long, record_key string")
    row = lineage.lineage(spark.createDataFrame([(5,)], "id long"), lineage.replay_links(loop, back), empty, empty).first()
    assert (row.replays, row.outcome) == (1, lineage.IN_FLIGHT)


def test_sketches_merge_in_any_order_within_the_rank_error(spark):
    rng = random.Random(7)
    values = [(i % 60, int(rng.lognormvariate(5, 1))) for i in range(30_000)] + [(3, None)]
    df = spark.createDataFrame(values, "minute int, ms long")
    parts = sketches.sketched(df, ["minute"], "ms")
    by_hour = parts.withColumn("k", F.lit("all"))
    halves = sketches.merged_sketches(by_hour, ["k", F.col("minute") % 7])
    for merged in (sketches.merged_sketches(by_hour, ["k"]), sketches.merged_sketches(halves, ["k"])):
        answers = sketches.estimates(merged, ["k"], (1, 50, 95, 99))
        rows = sketches.rank_spans(df.withColumn("k", F.lit("all")), ["k"], "ms", answers, (1, 50, 95, 99)).collect()
        assert len(rows) == 4
        for r in rows:
            assert r.samples == 30_000
            sorted_values = sorted(v for _, v in values if v is not None)
            assert r.under == sum(v < r.value for v in sorted_values)
            slack = sketches.RANK_ERROR * r.samples
            assert r.under - slack <= r.percent * r.samples / 100 <= r.upto + slack


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([("a", 5), ("a", 7), ("a", 9), ("b", None), (None, 4)], "k string, ms long")
    got = {(r.k, r.percent): r.value for r in sketches.estimates(sketches.sketched(df, ["k"], "ms"), ["k"], (1, 50, 99)).collect()}
    assert got == {("a", 1): 5, ("a", 50): 7, ("a", 99): 9, (None, 1): 4, (None, 50): 4, (None, 99): 4}
