"""Operators against brute force on small inputs."""

import math
import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import blocked, holds, lag, latency, reconcile, revenue, series
from ledgerline.schemas import RULES
from ledgerline.sources import samples
from ledgerline.operators.arrival import first_copies, gate_results, split_gate, unseen

few = settings(
    max_examples=25, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)

copies = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 900), st.integers(0, 300_000)), min_size=1, max_size=30
)


def orders(spark, rows):
    """(key, amount, produced_at) in arrival order."""
    data = [(f"o-{k}", i, a, p) for i, (k, a, p) in enumerate(rows)]
    return spark.createDataFrame(
        data, "order_id string, ingest_seq long, amount_cents long, produced_at long"
    )


def expected_minutes(rows):
    seen, minutes = set(), {}
    for key, amount, produced in rows:
        if key not in seen:
            seen.add(key)
            n, cents = minutes.get(produced // 60_000, (0, 0))
            minutes[produced // 60_000] = (n + 1, cents + amount)
    return minutes


def as_minutes(df):
    return {
        int((r.minute - datetime(1970, 1, 1)).total_seconds()) // 60: (r.order_count, r.total_cents)
        for r in df.collect()
    }


@few
@given(copies)
def test_first_copy_wins(spark, rows):
    shuffled = orders(spark, rows).orderBy(F.rand(1))
    got = revenue.per_minute(first_copies(shuffled, ["amount_cents", "produced_at"]))
    assert as_minutes(got) == expected_minutes(rows)


@few
@given(copies, st.integers(0, 30))
def test_gate_marks_only_new_first_copies(spark, rows, cut):
    everything = orders(spark, rows)
    ledger = first_copies(everything.filter(F.col("ingest_seq") < cut), [])
    got = gate_results(everything.filter(F.col("ingest_seq") >= cut), ledger)
    seen = {k for k, _, _ in rows[:cut]}
    expected = {}
    for i, (key, _, _) in enumerate(rows):
        if i >= cut:
            expected[i] = int(key not in seen)
            seen.add(key)
    assert {r.ingest_seq: r.applied for r in got.collect()} == expected


@few
@given(copies, st.integers(0, 30))
def test_split_gate_equals_the_gate(spark, rows, cut):
    everything = orders(spark, rows)
    ledger = first_copies(everything.filter(F.col("ingest_seq") < cut), [])
    want = gate_results(everything.filter(F.col("ingest_seq") >= cut), ledger)
    got = split_gate(everything, F.col("ingest_seq") < cut)
    columns = ["ingest_seq", "order_id", "applied"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())


def test_a_hot_order_is_combined_before_the_shuffle(spark):
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('o-', id)) AS order_id", "id AS ingest_seq",
        "id AS amount_cents",
    )
    first = first_copies(rows, ["amount_cents"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "HashAggregate" in plan
    assert "Window" not in plan and "SortAggregate" not in plan
    hot = first.filter("order_id = 'hot'").first()
    assert (hot.ingest_seq, hot.amount_cents, hot.copies) == (0, 0, 10_000)
    assert unseen(first, first.filter("order_id = 'hot'")).count() == 20_000


def test_merge_adds_both_sides(spark):
    a = revenue.per_minute(orders(spark, [(0, 5, 0), (1, 7, 60_000)]))
    b = revenue.per_minute(orders(spark, [(2, 11, 60_000)]))
    assert as_minutes(revenue.merged(a, b)) == {0: (1, 5), 1: (2, 18)}


def test_totals_of_nothing_are_zero(spark):
    none = revenue.per_minute(orders(spark, [(0, 5, 0)]).filter("false"))
    assert tuple(revenue.totals(none).first()) == (0, 0)


def test_minute_counter_expires_two_hours_after_its_last_write(spark):
    hour = 3_600_000
    applied = spark.createDataFrame(
        [(0, 1, 0), (0, 2, hour), (60_000, 4, 0)], "produced_at long, amount_cents long, committed_ms long"
    )

    def at(text):
        rows = revenue.hot_counters(applied, F.expr(f"TIMESTAMP_NTZ '1970-01-01 {text}'"))
        return {r.key: r.value for r in rows.collect()}

    assert at("02:30:00") == {
        "revenue:total_cents": 7,
        "revenue:order_count": 3,
        "revenue:minute:19700101T0000:cents": 3,
    }
    assert "revenue:minute:19700101T0000:cents" not in at("03:00:00")


points = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50)), min_size=1, max_size=25)


@few
@given(points, st.integers(1, 7))
def test_running_and_previous_across_blocks(spark, rows, width):
    data = [(k, t, v, t // width) for t, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, t int, v int, b int")
    ran = blocked.running(
        df, ["k"], "b", "t", sums={"total": F.col("v")}, maxima={"top": F.col("v")}
    )
    ran = blocked.previous(ran, ["k"], "b", "t", {"earlier": "v"})
    ran = blocked.position(ran, ["k"], "b", "t", "place")
    history = {}
    expected = {}
    for t, (k, v) in enumerate(rows):
        past = history.setdefault(k, [])
        expected[t] = (sum(past) + v, max([*past, v]), past[-1] if past else None, len(past))
        past.append(v)
    assert {r.t: (r.total, r.top, r.earlier, r.place) for r in ran.collect()} == expected


def brute_growth(samples, range_s, tick):
    """Growth and extrapolated increase from the definition, one tick at a time."""
    inside = [(t, v) for t, v in samples if tick - range_s <= t <= tick]
    if len(inside) < 2:
        return None
    gained = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
    covered = inside[-1][0] - inside[0][0]
    gap = covered / (len(inside) - 1)
    start, end = inside[0][0] - (tick - range_s), tick - inside[-1][0]
    if start >= gap * 1.1:
        start = gap / 2
    if gained > 0:
        start = min(start, covered * inside[0][1] / gained)
    if end >= gap * 1.1:
        end = gap / 2
    return gained, gained * (covered + start + end) / covered


@few
@given(
    st.lists(st.tuples(st.integers(1, 70), st.integers(0, 40)), min_size=2, max_size=25),
    st.sampled_from([(60, 15), (120, 30), (40, 60)]),
)
def test_growth_over_irregular_samples(spark, steps, window):
    range_s, step_s = window
    t, samples = 86_300, []
    for gap, value in steps:
        t += gap
        samples.append((t, value))
    df = spark.createDataFrame([(1, t, v) for t, v in samples], "s int, t long, v long")
    got = {r.tick: (r.growth, r.increase) for r in series.growth(df, ["s"], range_s, step_s).collect()}
    ticks = range(0, t + range_s + step_s, step_s)
    expected = {x: g for x in ticks if (g := brute_growth(samples, range_s, x))}
    assert got.keys() == expected.keys()
    for tick, (gained, increase) in expected.items():
        assert got[tick][0] == gained
        assert math.isclose(got[tick][1], increase, rel_tol=1e-9, abs_tol=1e-12)


def test_growth_stops_at_the_last_evaluation(spark):
    df = spark.createDataFrame([(0, 1), (10, 2), (20, 4)], "t long, v long")
    ticks = [r.tick for r in series.growth(df, [], 30, 10, F.lit(20)).collect()]
    assert sorted(ticks) == [10, 20]


def test_instant_and_latest_look_back(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 100, 6), (2, 0, 7)], "s int, t long, v long")
    got = {(r.s, r.tick): r.v for r in series.instant(df, ["s"], 60, 30).collect()}
    assert got == {
        (1, 0): 5, (1, 30): 5, (1, 60): 5, (1, 120): 6, (1, 150): 6, (2, 0): 7, (2, 30): 7, (2, 60): 7,
    }
    now = series.latest(df, ["s"], F.lit(110), 60).collect()
    assert [(r.s, r.v) for r in now] == [(1, 6)]


def test_quantiles(spark):
    inf = float("inf")
    rows = [("a", 1.0, 10), ("a", 2.0, 30), ("a", inf, 40), ("b", 1.0, 0), ("b", inf, 0),
            ("c", 1.0, 4), ("c", 2.0, 3), ("c", inf, 4)]
    df = spark.createDataFrame(rows, "k string, le double, cum long")
    got = {(r.k, r.q): r.value for r in series.quantiles(df, ["k"], (0.125, 0.5, 0.99)).collect()}
    assert got[("a", 0.125)] == 0.5  # rank 5 of the 10 in the first bucket
    assert got[("a", 0.5)] == 1.5  # rank 20: half way through the second
    assert got[("a", 0.99)] == 2.0  # open bucket: the bound below it
    assert got[("b", 0.5)] is None  # nothing observed
    assert got[("c", 0.5)] == 0.5  # a bucket below its neighbour is lifted


@few
@given(st.lists(st.sampled_from([0, 1, 2, 3]), min_size=1, max_size=40), st.integers(1, 4))
def test_stretches_with_false_null_and_missing_ticks(spark, values, hold):
    step = 21_600  # four ticks a day, so stretches cross days
    data = [(i * step, None if v == 2 else v) for i, v in enumerate(values) if v != 3]
    df = spark.createDataFrame(data or [(0, 0)], "tick long, v int")
    got = {
        r.tick: (r.since, r.state)
        for r in holds.alert(df, F.col("v") == 1, hold * step, step).collect()
    }
    expected, since = {}, None
    for i, v in enumerate(values):
        if v != 1:
            since = None
            continue
        since = i * step if since is None else since
        expected[i * step] = (since, "firing" if i * step - since >= hold * step else "pending")
    assert got == expected


def test_drained_needs_three_still_checks(spark):
    rows = [(0, 0, 0), (1, 5, 3), (2, 5, 5), (3, 5, 5), (4, 5, 5), (5, 5, 5), (6, 6, 5), (7, 6, 6)]
    df = spark.createDataFrame(rows, "tick long, produced long, consumed long")
    got = [(r.tick, r.stable_ticks) for r in holds.drained(df, 1).collect()]
    assert got == [(5, 3)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 20, 99, 100, 101, 5_000])
def test_snapshot_is_nearest_rank(spark, n):
    values = sorted(random.Random(n).randrange(0, 6_000) for _ in range(n))
    df = spark.createDataFrame([(v,) for v in values], "latency_ms long")

    def rank(p):
        return values[max(0, min(math.ceil(p / 100.0 * n) - 1, n - 1))] if n else 0

    row = latency.snapshot(latency.value_counts(df)).first()
    low, high = (values[0], values[-1]) if n else (0, 0)
    assert tuple(row) == (n, low, rank(50), rank(95), rank(99), high)


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(50,), (100,), (400,), (9_000,)], "latency_ms long")
    got = {r.le: r.cumulative for r in latency.histogram(df).collect()}
    assert got == {"0.1": 2, "0.25": 2, "0.5": 3, "1": 3, "2": 3, "5": 3, "+Inf": 4}


def test_lag_rules(spark):
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 10), ("t", 2, 10)],
                                 "topic string, record_partition int, end_offset long")
    commits = spark.createDataFrame([("t", 0, 4), ("t", 1, 15), ("t", 9, 1)],
                                    "topic string, record_partition int, committed_offset long")
    lags = lag.by_partition(ends, commits)
    assert {r.record_partition: r.lag for r in lags.collect()} == {0: 6, 1: 0, 2: 10}
    assert lag.total(lags).first().total_lag == 16
    assert lag.alert_count(lags.selectExpr("lag AS v"), 6).first().lag_alerts == 2


@few
@given(st.lists(st.tuples(st.sampled_from(["order", "poison", "tombstone", "unexpected"]),
                          st.integers(0, 3)), max_size=30))
def test_identity_balances(spark, rows):
    data = [(k, f"o-{i}" if k == "order" else None, n) for n, (k, i) in enumerate(rows)]
    df = spark.createDataFrame(data, "kind string, order_id string, ingest_seq long")
    row = reconcile.identity(reconcile.copies_by_key(df)).first()
    assert row.balanced and row.records == len(rows)
    assert row.unique_orders == len({o for _, o, _ in data if o})


def test_order_differences(spark):
    sent = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "order_id string")
    done = spark.createDataFrame([("a",), ("c",), ("c",), ("x",)], "order_id string")
    got = {(r.order_id, r.produced, r.applied) for r in reconcile.order_differences(sent, done).collect()}
    assert got == {("b", 1, 0), ("c", 1, 2), ("x", 0, 1)}


def test_null_keys_keep_their_rows(spark):
    rows = [(None, 0, i, i) for i in range(5)] + [("a", i % 2, i, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, b int, o int, v int")
    got = blocked.previous(blocked.running(df, ["k"], "b", "o", sums={"s": F.col("v")}), ["k"], "b", "o", {"p": "v"})
    assert sorted((r.k or "", r.o, r.s) for r in got.collect()) == [
        ("", 0, 0), ("", 1, 1), ("", 2, 3), ("", 3, 6), ("", 4, 10), ("a", 0, 1), ("a", 1, 3), ("a", 2, 2), ("a", 3, 4),
    ]


def test_growth_of_samples_at_one_instant(spark):
    df = spark.createDataFrame([(10, 1), (10, 5)], "t long, v long")
    assert series.growth(df, [], 60, 10).count() == 0


def test_log_end_is_past_the_last_offset(spark):
    df = spark.createDataFrame([("t", 0, o) for o in (0, 1, 5, 9)], "topic string, record_partition int, record_offset long")
    rows = df.withColumn("appended_at", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    assert lag.end_offsets(rows, F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'")).first().end_offset == 10


def test_records_of_the_first_hour_are_counted(spark, root):
    rows = [(i, t, 1, "a", 1.0, "") for i, t in enumerate([
        "2024-01-01 01:00:00", "2024-01-01 01:00:01", "2024-01-01 02:00:00", "2024-01-01 03:30:00",
    ])]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t").write.parquet(f"{root}/events.parquet")
    got = samples.consumed(spark, root).groupBy("t").agg(F.sum("v").alias("v")).orderBy("t").collect()
    assert [r.v for r in got] == [1, 3, 3]


def test_rules_name_their_alerts(spark):
    rule = RULES["lag_high"]
    df = spark.createDataFrame([(i * 15, 6_000) for i in range(6)], "tick long, lag long")
    rows = holds.by_rule(df, "lag", rule).orderBy("tick").collect()
    assert {(r.alert, r.severity, r.threshold) for r in rows} == {("ConsumerLagHigh", "warning", 5_000.0)}
    assert [r.state for r in rows] == ["pending"] * 4 + ["firing"] * 2


def test_lag_as_of_commits_at_any_time(spark):
    at = "TIMESTAMP_NTZ '2024-01-0{} {}:00:00'"
    ends = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('t', {p}, {at.format(d, h)}, {o}L)" for p, d, h, o in [(0, 1, 1, 5), (0, 1, 9, 20), (0, 4, 1, 30), (1, 2, 5, 7)]
    ) + " AS x(topic, record_partition, moment, end_offset)")
    commits = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('t', {p}, {at.format(d, h)}, {s}L, {o}L)"
        for p, d, h, s, o in [(0, 1, 1, 1, 3), (0, 1, 8, 2, 5), (0, 3, 2, 3, 4), (0, 4, 1, 4, 9), (1, 1, 1, 5, 2), (2, 1, 1, 6, 1)]
    ) + " AS x(topic, record_partition, moment, seq, committed_offset)")
    got = {r.seq: (r.end_offset, r.committed_offset, r.lag) for r in lag.lag_as_of(ends, commits).collect()}
    assert got == {1: (5, 3, 2), 2: (5, 5, 0), 3: (20, 5, 15), 4: (30, 9, 21), 5: (None, 2, 0), 6: (None, 1, 0)}


@pytest.mark.parametrize("range_s", [300, 86_400])
def test_a_range_costs_two_rows_a_tick(spark, range_s):
    """However long the range: samples go into panes, not to every tick that covers them."""
    df = spark.range(0, 6_000).select((F.col("id") * 15).alias("t"), F.col("id").alias("v"))
    per_tick = series.halves(df, [], range_s, 15).groupBy("tick").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.min("t0").alias("t0"), F.max("t1").alias("t1")
    )
    worst = per_tick.filter(F.col("tick") < 90_000).select(
        F.max("rows"), F.max(F.abs(F.col("n") - (F.col("t1") - F.col("t0")) / 15 - 1)),
        F.max(F.abs(F.col("t1") - F.col("tick"))), F.max(F.abs(F.greatest(F.col("tick") - range_s, F.lit(0)) - F.col("t0"))),
    ).first()
    assert tuple(worst) == (2, 0, 0, 0)


def test_growth_passes_over_samples_without_time_or_value(spark):
    df = spark.createDataFrame([("a", 0, 4), ("a", None, 9), ("a", 30, None), (None, 0, 1), ("a", 45, 1), (None, 60, 3)],
                               "s string, t long, v long")
    got = {(r.s, r.tick): r.growth for r in series.growth(df, ["s"], 60, 15, F.lit(60)).collect()}
    assert got == {("a", 45): 1, ("a", 60): 1, (None, 60): 2}
    assert series.growth(df.limit(0), ["s"], 60, 15).count() == 0


@pytest.mark.parametrize("name", ["lag_high", "lag_critical"])
def test_lag_rules_at_their_own_limits(spark, name):
    """Over the limit for 75 s, on it for a tick, over it for 45 s: one stretch fires."""
    rule = RULES[name]
    limit = int(rule.threshold)
    values = [0, *[limit + 1] * 6, limit, *[limit + 9] * 4, None, limit + 1]
    df = spark.createDataFrame([(i * 15, v) for i, v in enumerate(values)], "tick long, lag long")
    got = {r.tick // 15: (r.since // 15, r.state, r.threshold) for r in holds.by_rule(df, "lag", rule).collect()}
    expected = {i: (1, "firing" if i >= 5 else "pending", float(limit)) for i in range(1, 7)}
    expected |= {i: (8, "pending", float(limit)) for i in range(8, 12)} | {13: (13, "pending", float(limit))}
    assert got == expected
