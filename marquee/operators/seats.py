"""The seat ledger: reservations and releases in arrival order.

A booking id names one reservation, whatever flight it is asked for: once a
request was accepted, every later one for that booking answers EXISTING, on
any flight and also after its release; a rejected request leaves nothing.  A
release finds its flight through the booking's reservation as of its own time
and gives the seats back once.  So a flight's seats depend on its own earlier
calls, and through bookings on calls of other flights.

Flights that share a booking belong together, and so do flights joined by a
chain of such bookings.  Calls of flights so joined, up to ``chunk_rows`` of
them, are one group: its calls are dealt to one task and folded in order, once,
whatever the bookings do.  Which flights are joined is found from (hash of the
booking, flight) pairs; two bookings of one hash only join more.  Releases
go where their booking's least flight is.

Where joined flights have more calls than that, the ledger settles both at once:

1. Every reserve learns the first release after it (one ordered scan by
   booking).  Only that release can free what the reserve may take, so it is
   copied to the reserve's flight: at most one copy per reserve.
2. The calls of a flight are one group; a flight with more than ``chunk_rows``
   calls is cut into ordered chunks.  A group is folded in order with the
   bookings accepted inside it at hand.  A chunk's effect on the seats is
   tabulated for every possible start, so the chunks' starts come from
   composing tables and no task folds a whole hot flight.
3. What a group cannot know is whether a booking was accepted earlier in
   another group.  Only bookings that occur in several groups are looked at:
   their accepted requests are collected, the calls that these answer are
   noted, and flights whose notes changed are folded again, until no note
   changes.  Each round settles at least the earliest call, in arrival order,
   that was still wrong, so the fixpoint is the sequential ledger; flights
   without such bookings are folded once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.components import components
from ..functions.scan import keyed_position, keyed_running
from ..session import written

ACTIVE, EXHAUSTED, EXISTING, NOT_FOUND, RELEASED = "ACTIVE", "RESOURCE_EXHAUSTED", "EXISTING", "NOT_FOUND", "RELEASED"
RESERVE, RELEASE = "RESERVE", "RELEASE"
#: Calls of one flight that are folded in one piece.
CHUNK_ROWS = 65536

_CALLS = "flight_id long, chunk int, chunks int, seq long, op string, booking_id string, seats long, cap long, rel_seq long, shared boolean"
_OUT = "flight_id long, chunk int, seq long, op string, booking_id string, seats long, rel_seq long, shared boolean, status string, remaining long"


class Seats:
    """The seats of one flight and the reservations made on it, call by call,
    from ``start`` seats (None: no such flight).

    A note tells what happened to the booking elsewhere: a reserve with a note
    was accepted there before, a release with a note frees that many seats."""

    __slots__ = ("known", "left", "held")

    def __init__(self, start: int | None):
        self.known, self.left, self.held = start is not None, start, {}

    def answer(self, op: str, booking, seats: int, note: int | None) -> str:
        own = self.held.get(booking)
        if op == RELEASE:
            if note is not None:
                self.left += note
                return RELEASED
            if own is not None and own[0]:
                own[0] = False
                self.left += own[1]
                return RELEASED
            return NOT_FOUND
        if note is not None or own is not None:
            return EXISTING
        if not self.known:
            return NOT_FOUND
        if self.left < seats:
            return EXHAUSTED
        self.left -= seats
        if booking is not None:
            self.held[booking] = [True, seats]
        return ACTIVE


def transfer_table(ops, bookings, seats, notes, cap):
    """Seats left at the end for every start 0..cap, one vector step per call."""
    left = np.arange(cap + 1, dtype=np.int64)
    held: dict = {}
    for op, b, s, note in zip(ops, bookings, seats, notes):
        if op == RELEASE:
            if note is not None:
                left = left + note
            elif b in held:
                active, size = held[b][1:]
                left = left + np.where(active, size, 0)
                held[b][1] = np.zeros_like(active)
            continue
        if note is not None:
            continue
        taken = left >= s
        if b in held:
            taken &= ~held[b][0]
        left = np.where(taken, left - s, left)
        if b is None:
            continue
        if b in held:
            seen, active, size = held[b]
            held[b] = [seen | taken, active | taken, np.where(taken, s, size)]
        else:
            held[b] = [taken.copy(), taken.copy(), np.where(taken, s, 0)]
    return np.clip(left, 0, cap)


_ANSWERED = ["flight_id", "chunk", "seq", "op", "booking_id", "seats", "rel_seq", "shared"]
_READ = ["flight_id", "chunk", "op", "booking_id", "seats", "note", "cap", "start"]


def _fold_sorted(batches):
    """Every call with its answer; calls come sorted by (flight, chunk, seq)."""
    now, state = None, None
    for b in batches:
        status, remaining = [], []
        for flight, chunk, op, booking, seats, note, cap, start in zip(*(b.column(c).to_pylist() for c in _READ)):
            if state is None or (flight, chunk) != now:
                now, state = (flight, chunk), Seats(cap if start is None else start)
            status.append(state.answer(op, booking, seats, note))
            remaining.append(state.left)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _ANSWERED), pa.array(status, pa.string()), pa.array(remaining, pa.int64())],
                                         names=[*_ANSWERED, "status", "remaining"])


def _groups(batches):
    """The calls of each (flight, chunk) of sorted batches."""
    held, now = [], None
    for b in batches:
        flights, chunks = b.column("flight_id").to_numpy(zero_copy_only=False), b.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero((flights[1:] != flights[:-1]) | (chunks[1:] != chunks[:-1])) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            if a == z:
                continue
            key = (flights[a], chunks[a])
            if held and key != now:
                yield held[0] if len(held) == 1 else pa.concat_batches(held)
                held = []
            now = key
            held.append(b.slice(a, z - a))
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def _tables(batches):
    for group in _groups(batches):
        cap = group.column("cap")[0].as_py()
        if cap is not None:
            table = transfer_table(*(group.column(c).to_pylist() for c in ("op", "booking_id", "seats", "note")), cap)
            yield pa.RecordBatch.from_arrays([group.column("flight_id").slice(0, 1), group.column("chunk").slice(0, 1), pa.array([table.tolist()], pa.list_(pa.int64()))],
                                             names=["flight_id", "chunk", "table"])


def _starts(table):
    """The seats each chunk of one flight starts with: its chunks' tables in order."""
    rows = sorted(zip(table["chunk"].to_pylist(), table["table"].to_pylist()))
    start, out = len(rows[0][1]) - 1, []
    for _, ends in rows:
        out.append(start)
        start = ends[start]
    n = len(rows)
    return pa.table([table["flight_id"].combine_chunks().take(pa.array([0] * n)), pa.array([c for c, _ in rows], pa.int32()), pa.array(out, pa.int64())],
                    names=["flight_id", "chunk", "start"])


def _folded(rows: DataFrame, any_hot: bool) -> DataFrame:
    """Every noted call with its answer."""
    keys = ["flight_id", "chunk"]
    if any_hot:
        hot = rows.where("chunks > 1")
        tables = hot.repartition(*keys).sortWithinPartitions(*keys, "seq").mapInArrow(_tables, "flight_id long, chunk int, table array<long>")
        starts = tables.groupBy("flight_id").applyInArrow(_starts, "flight_id long, chunk int, start long")
        rows = rows.where("chunks = 1").withColumn("start", F.lit(None).cast("long")).unionByName(hot.join(starts, keys, "left"))
    else:
        rows = rows.withColumn("start", F.lit(None).cast("long"))
    return rows.repartition(*keys).sortWithinPartitions(*keys, "seq").mapInArrow(_fold_sorted, _OUT)


def _arranged(calls: DataFrame, flights: DataFrame, chunk_rows: int) -> tuple[DataFrame, bool]:
    """All calls in their groups (releases as copies on the flights where they
    may count), whether their booking occurs in several groups, and whether
    some flight has several chunks."""
    reserves = calls.where(F.col("op") == RESERVE)
    releases = calls.where((F.col("op") == RELEASE) & F.col("booking_id").isNotNull())
    released = releases.select("booking_id").distinct()
    # the first release after each reserve: a running minimum from the end
    both = calls.where(F.col("op").isin(RESERVE, RELEASE)).join(released, "booking_id", "left_semi").withColumn("back", -F.col("seq"))
    scanned = keyed_running(both, ["booking_id"], ["back"], F.when(F.col("op") == RELEASE, F.col("seq")), "min", "rel_seq").where(F.col("op") == RESERVE).drop("back")
    others = reserves.join(released, "booking_id", "left_anti").withColumn("rel_seq", F.lit(None).cast("long"))
    copies = scanned.where(F.col("rel_seq").isNotNull() & F.col("flight_id").isNotNull()).select(
        "flight_id", F.col("rel_seq").alias("seq"), "booking_id", F.lit(0).cast("long").alias("seats"), F.lit(RELEASE).alias("op"),
        F.lit(None).cast("long").alias("rel_seq")).distinct()
    rows = written(scanned.unionByName(others).unionByName(copies), "seat-rows")
    hot = written(rows.groupBy("flight_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > chunk_rows) & F.col("flight_id").isNotNull()), "seat-hot")
    any_hot = hot.limit(1).count() > 0
    if any_hot:
        cold = rows.join(hot, "flight_id", "left_anti").select("*", F.lit(0).alias("chunk"), F.lit(1).alias("chunks"))
        place = keyed_position(rows.join(hot, "flight_id"), ["flight_id"], ["seq"], "pos")
        cut = place.select(*rows.columns, F.floor((F.col("pos") - 1) / chunk_rows).cast("int").alias("chunk"), F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks"))
        rows = cold.unionByName(cut)
    else:
        rows = rows.select("*", F.lit(0).alias("chunk"), F.lit(1).alias("chunks"))
    caps = flights.select(F.col("id").cast("long").alias("flight_id"), F.col("available_seats").cast("long").alias("cap"))
    group = F.struct("flight_id", "chunk")
    several = rows.where(F.col("booking_id").isNotNull()).groupBy("booking_id").agg(F.min(group).alias("a"), F.max(group).alias("z")).where(
        ~F.col("a").eqNullSafe(F.col("z"))).select("booking_id", F.lit(True).alias("shared"))
    arranged = rows.join(caps, "flight_id", "left").join(several, "booking_id", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))
    return written(arranged.select(*[c.split()[0] for c in _CALLS.split(", ")]), "seat-arranged"), any_hot


def _note() -> Column:
    """What the booking's accepted request ``own`` (of some group) tells a call about it."""
    own = F.col("own")
    here = own["flight_id"].eqNullSafe(F.col("flight_id"))
    earlier = (own["seq"] < F.col("seq")) & ~(here & (own["chunk"] == F.col("chunk")))
    frees = (own["rel_seq"] == F.col("seq")) & here & (own["chunk"] < F.col("chunk"))
    return F.when((F.col("op") == RESERVE) & earlier, F.lit(0).cast("long")).when((F.col("op") == RELEASE) & frees, own["seats"])


def _noted(rows: DataFrame, accepted: DataFrame | None) -> DataFrame:
    """Calls with their notes; only bookings of several groups are joined."""
    bare = F.lit(None).cast("long").alias("note")
    if accepted is None:
        return rows.select("*", bare)
    noted = rows.where("shared").join(accepted, "booking_id", "left").withColumn("note", _note()).drop("own")
    return rows.where("not shared").select("*", bare).unionByName(noted)


def _first_accepted(taken: DataFrame) -> DataFrame:
    return taken.groupBy("booking_id").agg(F.min(F.struct("seq", "flight_id", "chunk", "seats", "rel_seq")).alias("own"))


_ANSWER = "seq long, op string, booking_id string, flight_id long, seats long, status string, remaining long"
_PLACED = ["place", "seq", "flight_id", "booking_id", "seats", "release", "cap"]


def _longs(column) -> list:
    """A column of longs as a list, by way of numpy where no value is null."""
    if not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return [v if ok else None for v, ok in zip(column.fill_null(0).to_numpy(zero_copy_only=False).tolist(), column.is_valid().to_numpy(zero_copy_only=False).tolist())]


def _fold_places(batches):
    """The answer to every call of whole groups of flights; calls come sorted by (place, seq)."""
    now, left, made = None, {}, {}
    for b in batches:
        ops, flights, sizes, status, remaining = [], [], [], [], []
        places, asked, size, caps = (_longs(b.column(c)) for c in ("place", "flight_id", "seats", "cap"))
        bookings, releases = (b.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("booking_id", "release"))
        for place, flight, booking, seats, release, cap in zip(places, asked, bookings, size, releases, caps):
            if place != now:
                now, left, made = place, {}, {}
            own = None if booking is None else made.get(booking)
            rest = None
            if release:
                if own is not None and own[2]:
                    own[2] = False
                    flight, seats = own[0], own[1]
                    rest = left[flight] = left[flight] + seats
                    said = RELEASED
                else:
                    flight, seats, said = None, None, NOT_FOUND
            else:
                if flight is not None:
                    rest = left.setdefault(flight, cap)
                if own is not None:
                    said = EXISTING
                elif rest is None:
                    said = NOT_FOUND
                elif rest < seats:
                    said = EXHAUSTED
                else:
                    rest = left[flight] = rest - seats
                    said = ACTIVE
                    if booking is not None:
                        made[booking] = [flight, seats, True]
            ops.append(RELEASE if release else RESERVE)
            flights.append(flight)
            sizes.append(seats)
            status.append(said)
            remaining.append(rest)
        yield pa.RecordBatch.from_arrays([b.column("seq"), pa.array(ops, pa.string()), b.column("booking_id"), pa.array(flights, pa.int64()), pa.array(sizes, pa.int64()),
                                          pa.array(status, pa.string()), pa.array(remaining, pa.int64())], names=[c.split()[0] for c in _ANSWER.split(", ")])


def seat_ledger(calls: DataFrame, flights: DataFrame, chunk_rows: int = CHUNK_ROWS, figures: dict | None = None) -> DataFrame:
    """the answer to every call: seq, op, booking_id, flight_id, seats,
    status, remaining.

    ``calls`` has flight_id (of reserves), seq (unique, in order of arrival
    over all flights), booking_id, seats and optionally ``op`` (RESERVE if
    absent, or RELEASE); ``flights`` has id and available_seats at the start.  A reserve answers
    EXISTING, else NOT_FOUND for an unknown flight, else RESOURCE_EXHAUSTED or
    ACTIVE; a release RELEASED (with the flight and seats it freed) or
    NOT_FOUND.  ``remaining`` are the flight's seats after the call, null
    where no flight was touched.  A null booking id is nobody's: its reserves
    are never repeats and cannot be released.  ``calls`` is read several times,
    so it should be stored or cheap.  ``figures`` takes the number of rounds (of
    joining flights, one if any are joined, and of folding again) and of flights
    folded again."""
    op = F.col("op") if "op" in calls.columns else F.lit(RESERVE)
    calls = calls.select(F.when(op == RESERVE, F.col("flight_id").cast("long")).alias("flight_id"), F.col("seq").cast("long").alias("seq"),
                         F.col("booking_id").cast("string").alias("booking_id"), F.coalesce(F.col("seats").cast("long"), F.lit(0).cast("long")).alias("seats"),
                         op.alias("op")).where(op.isin(RESERVE, RELEASE))
    release = (F.col("op") == RELEASE).alias("release")
    # the least flight of every booking: joined to the booking's others, and home of its calls that name no flight
    away = F.when(F.col("flight_id").isNull(), F.struct("seq", "booking_id", "seats", release)).alias("call")
    pairs = calls.where(F.col("booking_id").isNotNull()).select(F.xxhash64("booking_id").alias("h"), "flight_id", away)
    tied = pairs.withColumn("home", F.min("flight_id").over(Window.partitionBy("h"))).drop("h")
    tied = written(tied.where(F.col("call").isNotNull() | (F.col("flight_id") != F.col("home"))), "seat-tied", "zstd")
    joined = components(tied.where(F.col("call").isNull()).select("home", "flight_id").distinct(), "home", "flight_id").select(
        F.col("node").alias("flight_id"), F.col("root").alias("place"))
    homed = tied.where(F.col("call").isNotNull() & F.col("home").isNotNull()).select(F.col("home").alias("flight_id"), "call.*")
    asked = calls.where(F.col("flight_id").isNotNull())
    # groups of joined flights that are too large for one task
    count = lambda d: d.groupBy("flight_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = count(asked).unionByName(count(homed)).join(joined, "flight_id", "left").groupBy(F.coalesce("place", "flight_id").alias("place")).agg(F.sum("n").alias("n"))
    large = written(sizes.where(F.col("n") > chunk_rows).select("place"), "seat-large")
    caps = flights.select(F.col("id").cast("long").alias("flight_id"), F.col("available_seats").cast("long").alias("cap"))
    places = caps.join(joined, "flight_id", "full_outer")
    own_place = F.coalesce("place", "flight_id").alias("place")
    placed = asked.join(places, "flight_id", "left").select(own_place, "seq", "flight_id", "booking_id", "seats", release, "cap").unionByName(
        homed.join(joined, "flight_id", "left").select(own_place, "seq", F.lit(None).cast("long").alias("flight_id"), "booking_id", "seats", "release",
                                                       F.lit(None).cast("long").alias("cap")))
    # no flight was ever asked for these
    none = F.lit(None).cast("long")
    lost = tied.where(F.col("call").isNotNull() & F.col("home").isNull()).select("call.*").unionByName(
        calls.where(F.col("booking_id").isNull() & F.col("flight_id").isNull()).select("seq", "booking_id", "seats", release))
    named = F.when(F.col("release"), RELEASE).otherwise(RESERVE).alias("op")
    answers = lost.select("seq", named, "booking_id", none.alias("flight_id"), F.when(~F.col("release"), F.col("seats")).alias("seats"),
                          F.lit(NOT_FOUND).alias("status"), none.alias("remaining"))
    figures = {} if figures is None else figures
    figures.update(rounds=0, refolded=0)
    if large.limit(1).count():
        answers = answers.unionByName(_settled(placed.join(large, "place", "left_semi").select("flight_id", "seq", "booking_id", "seats", named), flights, chunk_rows, figures))
        placed = placed.join(large, "place", "left_anti").select(*_PLACED)
    figures["rounds"] += min(1, joined.limit(1).count())
    folded = placed.repartition("place").sortWithinPartitions("place", "seq").mapInArrow(_fold_places, _ANSWER)
    return folded.unionByName(answers)


def _settled(calls: DataFrame, flights: DataFrame, chunk_rows: int, figures: dict) -> DataFrame:
    """The answers of joined flights with more than ``chunk_rows`` calls, by rounds."""
    calls = written(calls, "seat-calls")
    rows, any_hot = _arranged(calls, flights, chunk_rows)
    # flights that hold a booking of several groups; the others never change
    joint = rows.where("shared").select(F.col("flight_id").alias("_f")).distinct()
    coupled = written(rows.join(joint, F.col("flight_id").eqNullSafe(F.col("_f")), "left_semi"), "seat-coupled")
    takes = (F.col("op") == RESERVE) & (F.col("status") == ACTIVE)
    part = ["booking_id", "seq", "flight_id", "chunk", "seats", "rel_seq"]
    mine = written(coupled.where("shared").select("booking_id", "flight_id").distinct(), "seat-shared")
    dirty, taken, accepted = coupled, None, None
    rounds = again = 0
    while True:
        found = _folded(_noted(dirty, accepted), any_hot).where(takes & F.col("shared")).select(*part)
        if taken is not None:
            old = taken.join(touched, F.col("flight_id").eqNullSafe(F.col("_f")), "left_anti")
            found = found.unionByName(old)
        taken = written(found, "seat-taken")
        before, accepted = accepted, written(_first_accepted(taken), "seat-accepted")
        if before is None:
            changed = accepted.select("booking_id")
        else:
            changed = (before.withColumnRenamed("own", "was").join(accepted, "booking_id", "full_outer").where(~F.col("was").eqNullSafe(F.col("own"))).select("booking_id"))
        touched = written(mine.join(changed, "booking_id", "left_semi").select(F.col("flight_id").alias("_f")).distinct(), "seat-touched")
        n = touched.count()
        if not n:
            break
        rounds, again = rounds + 1, again + n
        dirty = coupled.join(touched, F.col("flight_id").eqNullSafe(F.col("_f")), "left_semi")
    figures.update(rounds=rounds, refolded=again)
    answers = written(_folded(_noted(rows, accepted), any_hot), "seat-answers")
    reserved = answers.where(F.col("op") == RESERVE).select("seq", "op", "booking_id", "flight_id", "seats", "status", "remaining")
    freed = answers.where(F.col("status") == RELEASED).select("seq", F.col("flight_id").alias("f"), "booking_id", "remaining")
    # the seats that a release freed are those of the booking's accepted request
    size = answers.where(takes & F.col("rel_seq").isNotNull()).select(F.col("rel_seq").alias("seq"), F.col("seats").alias("s"))
    freed = freed.join(size, "seq", "left").select("seq", "f", "s", "remaining")
    released = calls.where(F.col("op") == RELEASE).drop("flight_id", "seats").join(freed, "seq", "left").select(
        "seq", "op", "booking_id", F.col("f").alias("flight_id"), F.col("s").alias("seats"),
        F.when(F.col("f").isNotNull(), RELEASED).otherwise(NOT_FOUND).alias("status"), "remaining")
    return reserved.unionByName(released)


def reservations(ledger: DataFrame) -> DataFrame:
    """The reservation table that a ledger leaves: booking_id, flight_id, seats, status (ACTIVE or RELEASED)."""
    # one pass over the ledger; a null booking is nobody's, so each is looked at alone
    of_booking = Window.partitionBy("booking_id", F.when(F.col("booking_id").isNull(), F.col("seq")))
    moves = ledger.where(F.col("status").isin(ACTIVE, RELEASED)).select("seq", "booking_id", "flight_id", "seats", (F.col("status") == RELEASED).alias("release"))
    return moves.withColumn("gone", F.max("release").over(of_booking)).where(~F.col("release")).select(
        "booking_id", "flight_id", "seats", F.when(F.col("gone"), RELEASED).otherwise(ACTIVE).alias("status"))


def seat_reconciliation(flights: DataFrame, reserved: DataFrame) -> DataFrame:
    """stored available seats against total seats less those held (ACTIVE reservations)."""
    held = reserved.where(F.col("status") == ACTIVE).groupBy("flight_id").agg(F.sum("seats").cast("long").alias("held"))
    f = flights.select(F.col("id").alias("flight_id"), F.col("total_seats").cast("long").alias("total_seats"), F.col("available_seats").cast("long").alias("available"))
    j = f.join(held, "flight_id", "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long")))
    return j.select("flight_id", "total_seats", "held", "available", (F.col("available") - (F.col("total_seats") - F.col("held"))).alias("drift"))
