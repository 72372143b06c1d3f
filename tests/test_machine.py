"""State machines and sliding sums are the same however a key is cut into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.functions.machine import run_machine
from marquee.functions.scan import keyed_running, keyed_sliding_sum
from marquee.operators import notify as nt

STATES = ["a", "b", "c"]
MOVES = [("", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("b", "a")]


def _sequential(rows):
    out = {}
    for k, o, e in sorted(rows, key=lambda r: r[1]):
        state, since, legal, illegal = out.get(k, ("", None, 0, 0))
        out[k] = (e, o, legal + 1, illegal) if (state, e) in MOVES else (state, since, legal, illegal + 1)
    return {k: (s or None, t, a, b) for k, (s, t, a, b) in out.items()}


@pytest.mark.parametrize("how", [{}, {"chunks": 7}, {"hot_rows": 50}])
def test_machine_over_chunks(spark, how):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 9)}", i, rnd.choice("abcx")) for i in range(800)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, e string").withColumn("t", F.timestamp_seconds("o"))
    got = {r.k: (r.state, None if r.since is None else int(r.s), r.legal_moves, r.illegal_moves)
           for r in run_machine(df, "k", ["o"], "e", "t", STATES, MOVES, **how).withColumn("s", F.unix_seconds("since")).collect()}
    assert got == _sequential(rows)


@pytest.mark.parametrize("how", [{}, {"chunks": 40}, {"hot_rows": 100}])
def test_sliding_sum_over_chunks(spark, how):
    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 60)}", i, rnd.randint(0, 5)) for i in range(900)]
    last, want = {}, {}
    for k, o, v in rows:
        last.setdefault(k, []).append(v)
        want[k, o] = sum(last[k][-10:])
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    got = keyed_sliding_sum(df, ["k"], ["o"], "v", 10, "s", **how)
    assert got.columns == ["k", "o", "v", "s"]
    assert {(r.k, r.o): r.s for r in got.collect()} == want


def test_running_aggregate_with_some_hot_keys(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i, i % 5) for i in range(600)]
    want, acc = {}, {}
    for k, o, v in rows:
        acc[k] = acc.get(k, 0) + v
        want[k, o] = acc[k]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(4)
    got = keyed_running(df, ["k"], ["o"], "v", "sum", "s", hot_rows=100)
    assert {(r.k, r.o): r.s for r in got.collect()} == want


def test_scans_of_small_keys_take_one_exchange(spark):
    df = spark.range(1000).selectExpr("id % 50 as k", "id as o", "id % 3 as v").repartition(4)
    out = keyed_sliding_sum(keyed_running(df, ["k"], ["o"], "v", "sum", "s"), ["k"], ["o"], "v", 5, "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k") == 1 and "Join" not in plan


def test_every_move_of_a_delivery(spark):
    a = spark.createDataFrame([(1, 7, "u", "push", "FAILED", 0, 10), (2, 7, "u", "sms", "FAILED", 20, 10), (3, 7, "u", "email", "FAILED", 40, 10),
                               (4, 8, "u", "push", "DELIVERED", 0, 10), (5, 8, "u", "sms", "DELIVERED", 30, 10), (6, 9, "u", "push", "FAILED", 0, 100), (7, 9, "u", "sms", "DELIVERED", 50, 10)],
                              "attempt_id long, notification_id long, user_id string, channel string, outcome string, s long, latency_ms long")
    a = a.withColumn("ts", F.timestamp_millis("s"))
    events = nt.state_events(a)
    assert {r.state for r in events.select("state").collect()} == set(nt.STATES)
    got = {r.notification_id: (r.state, r.legal_moves, r.illegal_moves) for r in nt.delivery_state(events).collect()}
    # 7: every channel failed; 8: sent again after delivery (two events not allowed);
    # 9: the second send starts while the first is in flight, its outcome ends the first, which then fails too late
    assert got == {7: ("EXHAUSTED", 10, 0), 8: ("DELIVERED", 3, 2), 9: ("DELIVERED", 3, 3)}
