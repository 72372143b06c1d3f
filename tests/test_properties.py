"""Set-wise rewrites of sequential rules equal a brute-force replay."""

import datetime as dt
import random

import pytest

from marquee.operators import flights as fl
from marquee.operators import notify as nt

BASE = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", [0, 1])
def test_booking_transitions_match_state_machine(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for b in range(60):
        times = rnd.sample(range(0, 40), rnd.randint(1, 6))
        for t in times:
            rows.append((f"B{b}", rnd.choice(["CREATE", "CANCEL"]), BASE + dt.timedelta(hours=t)))
    df = spark.createDataFrame(rows, "booking_id string, action string, event_at timestamp")
    got = {(r.booking_id, r.event_at): (r.from_status, r.to_status, r.legal)
           for r in fl.booking_transitions(df).collect()}
    exp, state = {}, {}
    for b, a, t in sorted(rows, key=lambda x: (x[0], x[2])):
        s = state.get(b)
        legal = (a == "CREATE" and s is None) or (a == "CANCEL" and s == "CONFIRMED")
        to = ("CONFIRMED" if a == "CREATE" else "CANCELLED") if legal else s
        exp[(b, t)] = (s, to, legal)
        state[b] = to
    assert got == exp


def _attempts(spark, rnd, n=400):
    rows = []
    for i in range(n):
        rows.append((i, rnd.randint(0, 20), f"user_{rnd.randint(0, 3)}", "billing", "TRANSACTIONAL",
                     rnd.choice(["push", "sms", "email"]), rnd.choice(["DELIVERED", "FAILED"]),
                     BASE + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 6)), rnd.randint(0, 9000)))
    schema = ("attempt_id long, notification_id long, user_id string, source_service string, type string, "
              "channel string, outcome string, ts timestamp, latency_ms long")
    return rows, spark.createDataFrame(rows, schema)


def test_failover_matches_brute_force(spark):
    rows, df = _attempts(spark, random.Random(5))
    prefs = spark.createDataFrame([("user_0", "email"), ("user_1", "sms"), ("user_2", None)], "user_id string, preferred_channel string")
    got = {r.attempt_id: (r.next_channel, r.reason) for r in nt.failover(df, nt.acks_of(df), prefs, chunks=5).collect()}
    chains = {"user_0": ["email", "push", "sms"], "user_1": ["sms", "push", "email"]}
    after = lambda u, c: dict(zip(ch := chains.get(u, ["push", "sms", "email"]), ch[1:])).get(c)
    acks = [(n, c, ts + dt.timedelta(milliseconds=lat)) for (_, n, _, _, _, c, o, ts, lat) in rows if o == "DELIVERED"]
    exp = {}
    for (aid, n, u, _, _, c, o, ts, _) in rows:
        timely = any(k_n == n and k_c == c and ts <= at <= ts + dt.timedelta(seconds=5) for k_n, k_c, at in acks)
        if o == "FAILED" or not timely:
            exp[aid] = (after(u, c), "FAILED" if o == "FAILED" else "ACK_TIMEOUT")
    assert got == exp


def test_dedup_ttl_matches_brute_force(spark):
    rows, df = _attempts(spark, random.Random(7), n=500)
    got = sorted(r.attempt_id for r in nt.dedup_ttl(df).collect())
    by_key = {}
    for r in sorted(rows, key=lambda x: (x[7], x[0])):
        by_key.setdefault((r[3], r[1], r[2], r[5]), []).append(r)
    exp = []
    for seq in by_key.values():
        last = None
        for r in seq:
            if last is None or r[7] >= last + dt.timedelta(hours=24):
                exp.append(r[0])
                last = r[7]
    assert got == sorted(exp)


def test_success_rolling_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        rows.append((i, 0, "u", "billing", rnd.choice(["TRANSACTIONAL", "MARKETING"]), rnd.choice(["push", "sms"]),
                     rnd.choice(["DELIVERED", "DELIVERED", "FAILED"]),
                     BASE + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5)), 0))
    schema = ("attempt_id long, notification_id long, user_id string, source_service string, type string, "
              "channel string, outcome string, ts timestamp, latency_ms long")
    got = {(r.channel, r.type, r.window_end): (r.attempts, r.delivered, r.success_ok)
           for r in nt.success_rolling(spark.createDataFrame(rows, schema)).collect()}
    hour = lambda t: t.replace(minute=0, second=0, microsecond=0)
    exp = {}
    for c, ty, h in {(r[5], r[4], hour(r[7])) for r in rows}:
        end = h + dt.timedelta(hours=1)
        inside = [r for r in rows if r[5] == c and r[4] == ty and end - dt.timedelta(hours=24) <= r[7] < end]
        ok = sum(r[6] == "DELIVERED" for r in inside)
        exp[(c, ty, end)] = (len(inside), ok, ok / len(inside) >= 0.995)
    assert got == exp
