"""Structured Streaming jobs.

* T1 ``ingest_stream``: wire rows -> contract check with quarantine -> typed
  rows -> day-partitioned Parquet store (file sinks, exactly-once through
  their commit logs).
* T2 incrementally kept states: ``streaming.states``.
* T3 ``dedup_stream``: ``dropDuplicatesWithinWatermark`` on event_id.
* T4 ``tumbling_counts``: day windows with a watermark for late events
  (batch form for the oracle).
* T5 ``session_rollup_stream``: per session id, a session window (gap)
  with a watermark; append mode emits a session once it is closed.
* N2 ``dedup_ttl_stream``: the 24 h TTL de-dup as keyed state per
  (idempotency key, channel) holding the last kept send time; the state
  expires with an event-time timeout once the watermark passes its TTL.
* N7 ``route_lanes``: notification stream -> one output folder per
  priority lane (``partitionBy("lane")``), so each lane has its own consumer.
* N5 ``failover_stream``: attempts left-outer-joined to acks within the
  ack timeout (stream-stream interval join with watermarks on both sides);
  an attempt without an ack is emitted once the watermark closes its
  interval, a FAILED one at once.
* F1 ``seat_stream``: the seat ledger as keyed state per flight
  (``transformWithStateInPandas``); the state is the remaining seats and a
  map of the flight's reservations with an optional expiry; also serves
  releases (F2).  A call touches two state rows; work per key and trigger is
  bounded by the trigger size.

Sources: Kafka and its Avro decoder are not on this classpath, so streams
read files with a fixed schema (``stream_table``); the Kafka form is
``sources.events.kafka_events``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import notify as nt
from ..operators import quality as qa
from ..sources import events as ev
from ..sources.tables import read_table


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream with its schema fixed up front."""
    schema = read_table(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)


def run_available(query) -> None:
    """Wait for an ``availableNow`` query and surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# ------------------------------------------------------------------- T1

def ingest_stream(raw: DataFrame, store_path: str, rejects_path: str, checkpoint: str, ingested_at=None,
                  spread: int = 4):
    """Stream of wire rows -> contract check (V1) -> typed rows (S2) ->
    day-partitioned store (S3); rows that break the contract land in
    ``rejects_path`` with their reasons.  One availableNow run of two file
    sinks, each exactly-once by its commit log.  Rows are dealt by (day, user
    hash), so a trigger writes at most ``spread`` files per day."""
    valid, rejected = qa.split_valid(qa.event_contract(raw))
    stored = ev.with_store_columns(ev.type_events(valid), ingested_at)
    dealt = stored.repartition(F.col("event_date"), F.pmod(F.xxhash64("user_id"), F.lit(spread)))
    sinks = ((dealt.writeStream.partitionBy("event_date"), store_path, "store"), (rejected.writeStream, rejects_path, "rejects"))
    queries = [w.format("parquet").option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start(path)
               for w, path, name in sinks]
    for q in queries:
        run_available(q)
    return queries


# ------------------------------------------------------------------- T3/T4

def dedup_stream(stored_stream: DataFrame, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Drop repeats of ``key`` while the watermark keeps them in state."""
    return stored_stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])


def tumbling_counts(me: DataFrame, width: str = "1 day") -> DataFrame:
    """T4 batch form: events per (window start, event_type)."""
    w = F.window("event_time", width)
    return (me.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "event_type", "n"))


def tumbling_counts_stream(stored_stream: DataFrame, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """T4 streaming form: append mode emits a window once the watermark
    (max event time - ``delay``) passes its end; later events are dropped."""
    w = F.window("event_time", width)
    return (stored_stream.withWatermark("event_time", delay).groupBy(w.alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "event_type", "n"))


def session_rollup_stream(stored_stream: DataFrame, gap: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """T5 streaming form: ``session_rollup`` per session id, closed when no
    event of the session arrived for ``gap`` past the watermark.  A
    producer-supplied session id whose events lie within ``gap`` of each
    other yields the batch row; a longer pause splits it."""
    at = F.struct("event_time", "event_id")
    return (stored_stream.withWatermark("event_time", delay)
            .groupBy("session_id", F.session_window("event_time", gap).alias("w"))
            .agg(F.min("event_time").alias("started_at"),
                 F.max("event_time").alias("ended_at"),
                 F.max_by("progress_seconds", F.when(F.col("progress_seconds").isNotNull(), at)).alias("last_progress"),
                 (F.count_if(F.col("event_type") == "VIEW_FINISHED") > 0).alias("finished"))
            .drop("w"))


# ------------------------------------------------------------------- F1

SEAT_OUT = T.StructType([
    T.StructField("flight_id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()),
    T.StructField("booking_id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("remaining", T.LongType()),
])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _StoredBookings:
    """The reservations of a flight as map state: one state row per booking,
    read and written by its key only."""

    def __init__(self, state):
        self.state = state

    def get(self, booking):
        if booking is None or not self.state.containsKey((booking,)):
            return None
        active, count = self.state.getValue((booking,))
        return _Stored(self.state, booking, active, count)

    def __setitem__(self, booking, own):
        self.state.updateValue((booking,), (bool(own[0]), int(own[1])))


class _Stored(list):
    """[active, seats] of a booking; a change goes to its state row."""

    def __init__(self, state, booking, active, count):
        super().__init__((active, count))
        self.state, self.booking = state, booking

    def __setitem__(self, i, value):
        super().__setitem__(i, value)
        self.state.updateValue((self.booking,), (bool(self[0]), int(self[1])))


class SeatProcessor(StatefulProcessor):
    """F1/F2 for one flight: the seats left as value state, its reservations
    as map state with an optional time to live."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getValueState("seats_left", "seats_left long")
        self.made = handle.getMapState("reservations", "booking_id string", "active boolean, seats long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues):
        from ..operators.seats import Seats  # the same rule as the batch ledger
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        cap = pdf["cap"].iloc[0]
        start = int(self.left.get()[0]) if self.left.exists() else None if pd.isna(cap) else int(cap)
        flight = Seats(start)
        flight.held = _StoredBookings(self.made)
        status, remaining = [], []
        for op, booking, seats in zip(pdf["op"], pdf["booking_id"], pdf["seats"]):
            status.append(flight.answer(op, booking, int(seats), None))
            remaining.append(flight.left)
        if start is not None:
            self.left.update((int(flight.left),))
        yield pd.DataFrame({"flight_id": pdf["flight_id"].to_numpy(), "seq": pdf["seq"].to_numpy(), "op": pdf["op"].to_numpy(), "booking_id": pdf["booking_id"].to_numpy(),
                            "status": status, "remaining": pd.array(remaining, dtype="Int64")})

    def close(self) -> None:
        pass


def seat_stream(calls: DataFrame, flights: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """F1/F2 over a stream of calls, keyed by flight: calls of a micro-batch
    are answered in ``seq`` order after those of earlier batches.

    State is one row for a flight's seats and one row per reservation, so a
    call touches two rows however many the flight holds.  With ``keep_ms`` a
    reservation is forgotten that long after its last change (processing
    time); its booking may then be asked for again.  A release carries the
    flight of its booking.  Keyed state sees one flight: a booking that asks
    on several flights is only known on each of them, the batch ledger settles
    it over all.  Flights is a static table (stream-static left join: calls
    of unknown flights are answered NOT_FOUND).  Needs the RocksDB state
    store, which this sets."""
    calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    f = flights.select(F.col("id").cast("long").alias("flight_id"), F.col("available_seats").cast("long").alias("cap"))
    op = F.col("op") if "op" in calls.columns else F.lit("RESERVE")
    r = calls.select(F.col("flight_id").cast("long").alias("flight_id"), F.col("seq").cast("long").alias("seq"),
                     "booking_id", F.coalesce(F.col("seats").cast("long"), F.lit(0)).alias("seats"),
                     op.alias("op")).join(f, "flight_id", "left")
    return r.groupBy("flight_id").transformWithStateInPandas(
        SeatProcessor(keep_ms), SEAT_OUT, "append", "ProcessingTime" if keep_ms else "None")


# ------------------------------------------------------------------- N2/N5

def _ttl_state_fn(ttl_us: int):
    def fn(key, batches, state):
        if state.hasTimedOut:          # the watermark passed the TTL: forget
            state.remove()
            return
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(["_t", "attempt_id"], kind="stable")
        last = int(state.get[0]) if state.exists else None
        ts = pdf["_t"].to_numpy()
        keep = np.zeros(len(pdf), dtype=bool)
        for i, t in enumerate(ts):
            if last is None or t >= last + ttl_us:
                keep[i] = True
                last = int(t)
        expiry_ms = (last + ttl_us) // 1000
        if expiry_ms <= state.getCurrentWatermarkMs():
            state.remove()             # any later attempt is kept anyway
        else:
            state.update((last,))
            state.setTimeoutTimestamp(expiry_ms)
        yield pdf.loc[keep].drop(columns="_t")
    return fn


def dedup_ttl_stream(attempts: DataFrame, ttl_hours: int = nt.DEDUP_TTL_HOURS, delay: str = "1 hour") -> DataFrame:
    """N2 over an attempt stream: keyed state per (idem_key, channel) with
    the last kept send time.  Equals the batch ``dedup_ttl`` when each key's
    attempts arrive in send order (later triggers carry later sends);
    attempts older than the watermark are dropped as late.  Work per key
    and trigger is bounded by the trigger size (``maxFilesPerTrigger`` /
    ``maxOffsetsPerTrigger``); the state per key is one number."""
    a = (attempts.withWatermark("ts", delay)
         .withColumn("idem_key", nt.idem_key(F.col("source_service"), F.col("notification_id"), F.col("user_id")))
         .withColumn("_t", F.unix_micros("ts")))
    out_schema = T.StructType([f for f in a.schema.fields if f.name != "_t"])
    state_schema = T.StructType([T.StructField("last_kept_us", T.LongType())])
    return a.groupBy("idem_key", "channel").applyInPandasWithState(
        _ttl_state_fn(ttl_hours * 3600 * 1_000_000), out_schema, state_schema, "append",
        GroupStateTimeout.EventTimeTimeout)


def failover_stream(attempts: DataFrame, acks: DataFrame, prefs: DataFrame | None = None, timeout_ms: int = nt.ACK_TIMEOUT_MS,
                    chain: list[str] | None = None, delay: str = "1 minute") -> DataFrame:
    """N5 over streams: same rows as the batch ``failover``.  FAILED attempts
    hand over at once; a delivered attempt hands over when no ack of its
    (notification, channel) lands in [ts, ts + timeout] -- a stream-stream
    left outer join whose unmatched rows appear once the watermark passes
    the interval, so join state stays bounded by delay + timeout."""
    a = nt.with_plan(attempts.withWatermark("ts", delay), prefs, chain).select(
        "attempt_id", "notification_id", "channel", "outcome", "ts", "plan")
    k = acks.withWatermark("ack_at", delay).select(F.col("notification_id").alias("k_nid"),
                                                   F.col("channel").alias("k_ch"), "ack_at")

    def shape(df: DataFrame, reason: str) -> DataFrame:
        return df.select("notification_id", F.col("channel").alias("failed_channel"),
                         nt.next_in_plan(F.col("plan"), F.col("channel")).alias("next_channel"),
                         F.lit(reason).alias("reason"), "attempt_id")

    failed = a.where(F.col("outcome") == "FAILED")
    sent = a.where(F.col("outcome") != "FAILED")
    cond = ((F.col("notification_id") == F.col("k_nid")) & (F.col("channel") == F.col("k_ch"))
            & (F.col("ack_at") >= F.col("ts"))
            & (F.col("ack_at") <= F.col("ts") + F.expr(f"INTERVAL {int(timeout_ms)} MILLISECONDS")))
    timed_out = sent.join(k, cond, "leftOuter").where(F.col("ack_at").isNull())
    return shape(failed, "FAILED").unionByName(shape(timed_out, "ACK_TIMEOUT"))


def route_lanes(notifications: DataFrame, out_path: str, checkpoint: str):
    """N7 over a stream: every notification lands in its lane's folder
    (``lane=transactional|service|marketing``); one availableNow run."""
    q = (notifications.withColumn("lane", nt.lane_of(F.col("type")))
         .writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("lane").trigger(availableNow=True).start(out_path))
    run_available(q)
