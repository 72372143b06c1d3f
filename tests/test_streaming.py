"""Streams equal the batch operators over the same rows."""

from pyspark.sql import functions as F

from conftest import SF0001
from marquee.operators import seats as se
from marquee.session import scratch_path
from marquee.sources import fixtures as fx
from marquee.streaming import jobs as sj


def _collect_stream(df, spark, name, root):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{root}/{name}").trigger(availableNow=True).start())
    sj.run_available(q)
    return spark.table(name)


def test_dedup_stream_equals_batch(spark):
    root = scratch_path(spark, "stream-dedup")
    events = sj.stream_table(spark, SF0001, "events")
    me = fx.movie_events_from(events)
    twice = me.unionByName(me)          # every event delivered twice
    out = _collect_stream(sj.dedup_stream(twice), spark, "dedup_out", root)
    assert out.count() == fx.movie_events(spark, SF0001).count()
    assert out.select("event_id").distinct().count() == out.count()


def test_tumbling_stream_closed_windows_equal_batch(spark):
    root = scratch_path(spark, "stream-tumble")
    me_stream = fx.movie_events_from(sj.stream_table(spark, SF0001, "events"))
    out = _collect_stream(sj.tumbling_counts_stream(me_stream, "1 day", "1 day"), spark, "tumble_out", root)
    batch = sj.tumbling_counts(fx.movie_events(spark, SF0001), "1 day")
    # only windows closed by the watermark are emitted in append mode
    closed = {tuple(r) for r in out.collect()}
    assert closed and closed <= {tuple(r) for r in batch.collect()}


def test_seat_stream_equals_batch_ledger(spark):
    """Calls in three files, one per trigger; each booking stays on one flight, where the stream knows it."""
    root = scratch_path(spark, "stream-seat")
    calls = fx.seat_calls(spark, SF0001).withColumn("block", F.floor(F.coalesce("flight_id", F.lit(0)) / 4))
    home = calls.where("op = 'RESERVE' and flight_id < 1000000000").groupBy("booking_id").agg(F.min("flight_id").alias("home"))
    calls = calls.join(home, "booking_id", "left").select(F.coalesce("home", F.lit(10 ** 9)).cast("long").alias("flight_id"), "seq", "booking_id", "seats", "op")
    calls = calls.where("op = 'RESERVE' or flight_id < 1000000000").repartition(1).cache()
    n = calls.agg(F.max("seq")).first()[0]
    for k in range(3):
        calls.where((F.col("seq") > n * k // 3) & (F.col("seq") <= n * (k + 1) // 3)).coalesce(1).write.mode("append").parquet(f"{root}/calls")
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/calls")
    flights = fx.flights(spark, SF0001)
    out = _collect_stream(sj.seat_stream(stream, flights), spark, "seat_out", root)
    batch = se.seat_ledger(calls, flights)
    key = lambda r: r.seq
    got, want = sorted(out.collect(), key=key), sorted(batch.collect(), key=key)
    assert len(got) == len(want) and {"RELEASED", "EXISTING", "NOT_FOUND", "ACTIVE", "RESOURCE_EXHAUSTED"} == {r.status for r in got}
    for g, w in zip(got, want):
        assert (g.seq, g.op, g.booking_id, g.status) == (w.seq, w.op, w.booking_id, w.status)
        if w.flight_id is not None:  # a release that freed nothing names no flight in the ledger
            assert (g.flight_id, g.remaining) == (w.flight_id, w.remaining)


def _weekly_attempt_stream(spark, root):
    """The attempts fixture as one file per week, written in week order, read
    one file per trigger: each key's sends arrive in time order."""
    from marquee.sources import fixtures as fxs
    path = f"{root}/attempts"
    a = fxs.retried_attempts(spark, SF0001).withColumn("wk", F.floor(F.unix_seconds("ts") / (7 * 86400)))
    weeks = sorted(r.wk for r in a.select("wk").distinct().collect())
    for w in weeks:
        a.where(F.col("wk") == w).drop("wk").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), spark.read.parquet(path)


def test_ttl_dedup_stream_equals_batch(spark):
    from marquee.operators import notify as nt
    root = scratch_path(spark, "stream-ttl")
    stream, static = _weekly_attempt_stream(spark, root)
    out = _collect_stream(sj.dedup_ttl_stream(stream), spark, "ttl_out", root)
    got = sorted(r.attempt_id for r in out.select("attempt_id").collect())
    exp = sorted(r.attempt_id for r in nt.dedup_ttl(static).select("attempt_id").collect())
    assert got and got == exp


def test_failover_stream_equals_batch_on_closed_intervals(spark):
    from marquee.operators import notify as nt
    root = scratch_path(spark, "stream-failover")
    stream, static = _weekly_attempt_stream(spark, root)
    prefs = fx.user_channels(spark, SF0001)
    out = _collect_stream(sj.failover_stream(stream, nt.acks_of(stream), prefs), spark, "failover_out", root)
    got = {tuple(r) for r in out.collect()}
    batch = nt.failover(static, nt.acks_of(static), prefs)
    exp = {tuple(r) for r in batch.collect()}
    assert got and got <= exp
    # everything the last watermark has closed is there
    last = static.agg(F.max("ts")).first()[0]
    closed = batch.join(static.select("attempt_id", "ts"), "attempt_id").where(
        F.col("ts") < F.lit(last) - F.expr("INTERVAL 10 MINUTES")).select(*batch.columns)
    assert {tuple(r) for r in closed.collect()} <= got


def test_session_stream_closed_sessions_equal_batch(spark):
    from marquee.operators import quality as qa
    root = scratch_path(spark, "stream-session")
    me_stream = fx.movie_events_from(sj.stream_table(spark, SF0001, "events"))
    out = _collect_stream(sj.session_rollup_stream(me_stream, "1 day", "1 hour"), spark, "session_out", root)
    me = fx.movie_events(spark, SF0001)
    batch = qa.session_rollup(me)
    got = {tuple(r) for r in out.collect()}
    assert got and got <= {tuple(r) for r in batch.collect()}
    last = me.agg(F.max("event_time")).first()[0]
    closed = batch.where(F.col("ended_at") < F.lit(last) - F.expr("INTERVAL 2 DAYS"))
    assert {tuple(r) for r in closed.collect()} <= got


def test_lane_routing_stream_equals_batch_counts(spark):
    from marquee.operators import notify as nt
    root = scratch_path(spark, "stream-lanes")
    notif_stream = fx.notifications_from(sj.stream_table(spark, SF0001, "events"))
    sj.route_lanes(notif_stream, f"{root}/lanes", f"{root}/ckpt")
    written = spark.read.parquet(f"{root}/lanes")
    got = {(r.lane, r.n) for r in written.groupBy("lane").agg(F.count(F.lit(1)).alias("n")).collect()}
    exp = {(r.lane, r.n) for r in nt.lanes(fx.notifications(spark, SF0001)).collect()}
    assert got == exp
    # a lane's consumer reads only its folder
    plan = written.where(F.col("lane") == "transactional")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lane" in plan
