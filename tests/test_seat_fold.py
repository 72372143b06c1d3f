"""The seat ledger equals the sequential ledger: bookings on several flights,
releases, flights that span many chunks."""

import random

import numpy as np
import pytest

from marquee.operators import seats as se


def sequential(calls, caps):
    """Every call in order of arrival, by the service's rule."""
    left, made, out = dict(caps), {}, {}
    for seq, op, b, f, s in sorted(calls, key=lambda c: c[0]):
        own = made.get(b) if b is not None else None
        if op == "RELEASE":
            if own and own[2]:
                own[2] = False
                left[own[0]] += own[1]
                out[seq] = ("RELEASED", own[0], own[1], left[own[0]])
            else:
                out[seq] = ("NOT_FOUND", None, None, None)
        elif own:
            out[seq] = ("EXISTING", f, s, left.get(f))
        elif f not in left:
            out[seq] = ("NOT_FOUND", f, s, None)
        elif left[f] >= s:
            left[f] -= s
            if b is not None:
                made[b] = [f, s, True]
            out[seq] = ("ACTIVE", f, s, left[f])
        else:
            out[seq] = ("RESOURCE_EXHAUSTED", f, s, left[f])
    return out


def _run(spark, calls, caps, **how):
    df = spark.createDataFrame([(f, seq, b, s, op) for seq, op, b, f, s in calls], "flight_id long, seq long, booking_id string, seats long, op string")
    flights = spark.createDataFrame(list(caps.items()), "id long, available_seats long")
    return {r.seq: (r.status, r.flight_id, r.seats, r.remaining) for r in se.seat_ledger(df, flights, **how).collect()}


def _calls(rnd, n, flights, bookings, releases=0.0, hot=0.6, far=9):
    out = []
    for seq in rnd.sample(range(1, 10 * n), n):
        op = "RELEASE" if rnd.random() < releases else "RESERVE"
        f = flights[0] if rnd.random() < hot else rnd.choice([*flights[1:], far])
        b = f"b{rnd.randint(0, bookings)}" if rnd.random() < 0.98 else None
        out.append((seq, op, b, f if op == "RESERVE" else None, rnd.randint(1, 6) if op == "RESERVE" else None))
    return out


def _fill(calls):
    return {seq: c for seq, *c in calls}


def _compare(got, want, calls):
    by = _fill(calls)
    assert set(got) == set(want)
    for seq, w in want.items():
        assert got[seq] == w, (seq, by[seq], got[seq], w)


def test_golden_sequence(spark):
    calls = [(1, "RESERVE", "b1", 1, 60), (2, "RESERVE", "b2", 1, 60), (3, "RESERVE", "b1", 2, 5), (4, "RESERVE", "b2", 2, 60), (5, "RELEASE", "b1", None, None),
             (6, "RELEASE", "b1", None, None), (7, "RESERVE", "b1", 1, 60), (8, "RESERVE", "b3", 1, 100), (9, "RELEASE", "b2", None, None), (10, "RELEASE", "zz", None, None)]
    got = _run(spark, calls, {1: 100, 2: 60})
    assert [got[i][0] for i in range(1, 11)] == ["ACTIVE", "RESOURCE_EXHAUSTED", "EXISTING", "ACTIVE", "RELEASED", "NOT_FOUND", "EXISTING", "ACTIVE", "RELEASED", "NOT_FOUND"]
    assert got[5][1:] == (1, 60, 100) and got[9][1:] == (2, 60, 60) and got[8][3] == 0
    _compare(got, sequential(calls, {1: 100, 2: 60}), calls)


@pytest.mark.parametrize("seed,chunk_rows", [(0, 10 ** 6), (1, 150), (2, 40)])
def test_bookings_over_flights_with_a_hot_flight(spark, seed, chunk_rows):
    rnd = random.Random(seed)
    caps = {1: 300, 2: 40, 3: 25, 4: 10}
    calls = _calls(rnd, 1200, list(caps), 700)
    figures = {}
    _compare(_run(spark, calls, caps, chunk_rows=chunk_rows, figures=figures), sequential(calls, caps), calls)
    assert figures["rounds"] >= 1


@pytest.mark.parametrize("seed,chunk_rows", [(3, 10 ** 6), (4, 60)])
def test_random_reserve_release_across_chunks(spark, seed, chunk_rows):
    rnd = random.Random(seed)
    caps = {1: 120, 2: 30, 3: 50}
    calls = _calls(rnd, 900, list(caps), 400, releases=0.3)
    _compare(_run(spark, calls, caps, chunk_rows=chunk_rows), sequential(calls, caps), calls)


def test_no_shared_booking_needs_no_round(spark):
    calls = [(i, "RESERVE", f"b{i // 3}", i // 30, 1 + i % 4) for i in range(300)]
    figures = {}
    caps = {f: 20 for f in range(10)}
    _compare(_run(spark, calls, caps, figures=figures), sequential(calls, caps), calls)
    assert figures == {"rounds": 0, "refolded": 0}
    assert _run(spark, [], caps) == {}


def test_tables_equal_folds_from_every_start():
    rnd = random.Random(5)
    for _ in range(30):
        ops = [rnd.choice(["RESERVE", "RESERVE", "RELEASE"]) for _ in range(40)]
        books = [rnd.choice([None, *"abcdefg"]) for _ in ops]
        notes = [rnd.choice([None] * 9 + [0 if op == "RESERVE" else 2]) for op in ops]
        size = [rnd.randint(1, 5) for _ in ops]
        table = se.transfer_table(ops, books, size, notes, 25)
        states = [se.Seats(r) for r in range(26)]
        for state in states:
            for call in zip(ops, books, size, notes):
                state.answer(*call)
        assert table.tolist() == np.clip([state.left for state in states], 0, 25).tolist()


def test_reservations_and_reconciliation(spark):
    calls = [(1, "RESERVE", "b1", 1, 4), (2, "RESERVE", "b2", 1, 5), (3, "RELEASE", "b1", None, None), (4, "RESERVE", "b3", 2, 1)]
    df = spark.createDataFrame([(f, seq, b, s, op) for seq, op, b, f, s in calls], "flight_id long, seq long, booking_id string, seats long, op string")
    flights = spark.createDataFrame([(1, 10, 10), (2, 10, 10), (3, 10, 10)], "id long, total_seats int, available_seats int")
    made = se.reservations(se.seat_ledger(df, flights))
    assert sorted(map(tuple, made.collect())) == [("b1", 1, 4, "RELEASED"), ("b2", 1, 5, "ACTIVE"), ("b3", 2, 1, "ACTIVE")]
    stored = spark.createDataFrame([(1, 10, 5), (2, 10, 10), (3, 10, 10)], "id long, total_seats int, available_seats int")
    assert sorted((r.flight_id, r.held, r.drift) for r in se.seat_reconciliation(stored, made).collect()) == [(1, 5, 0), (2, 1, 1), (3, 0, 0)]


def _block_calls(rnd, n, blocks, hot=0):
    """Calls whose bookings ask on flights of one block of four, on no flight, or on an unknown one."""
    out = []
    for seq in rnd.sample(range(1, 10 * n), n):
        block = 0 if rnd.random() < hot else rnd.randrange(blocks)
        b = f"{block}-{rnd.randint(0, n // blocks // 2)}" if rnd.random() < 0.97 else None
        if rnd.random() < 0.25:
            out.append((seq, "RELEASE", b, None, None))
        else:
            out.append((seq, "RESERVE", b, rnd.choice([block * 4 + k for k in range(4)] + [10 ** 9 + block, None]), rnd.randint(1, 6)))
    return out


@pytest.mark.parametrize("hot,chunk_rows", [(0, se.CHUNK_ROWS), (0.4, 150)])
def test_joined_flights_are_folded_once(spark, hot, chunk_rows):
    """F3-F5 of round 3: flights joined by bookings are one group; only groups too large for a task take rounds."""
    rnd = random.Random(8)
    caps = {f: rnd.randint(5, 40) for f in range(40)}
    calls, figures = _block_calls(rnd, 1200, 10, hot), {}
    _compare(_run(spark, calls, caps, chunk_rows=chunk_rows, figures=figures), sequential(calls, caps), calls)
    if hot:
        assert 0 < figures["refolded"] <= 5 * figures["rounds"]  # the hot block's flights alone
    else:
        assert figures == {"rounds": 1, "refolded": 0}


def test_reservations_read_the_ledger_once(spark):
    ledger = spark.createDataFrame([(1, "RESERVE", "b1", 1, 4, "ACTIVE", 6), (2, "RESERVE", None, 1, 5, "ACTIVE", 1), (3, "RESERVE", None, 2, 1, "ACTIVE", 9),
                                    (4, "RELEASE", "b1", 1, 4, "RELEASED", 5), (5, "RELEASE", None, None, None, "NOT_FOUND", None)], se._ANSWER)
    made = se.reservations(ledger)
    assert sorted((r.flight_id, r.seats, r.booking_id, r.status) for r in made.collect()) == [(1, 4, "b1", "RELEASED"), (1, 5, None, "ACTIVE"), (2, 1, None, "ACTIVE")]
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
