"""Hand-made golden rows (FIXTURES.md section C) and the reference's
pipeline cases (contract reject, field fidelity, session of four)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from marquee.operators import flights as fl
from marquee.operators import metrics as m
from marquee.operators import notify as nt
from marquee.operators import orders as od
from marquee.operators import quality as qa
from marquee.operators import retention as r
from marquee.operators import store as st
from marquee.sources import events as ev

ME_SCHEMA = ("event_id string, user_id string, movie_id string, event_type string, event_time timestamp, "
             "event_date date, device_type string, session_id string, progress_seconds int")


def me_rows(spark, rows):
    """rows: (event_id, user, event_type, 'YYYY-mm-dd HH:MM:SS', progress)"""
    out = []
    for eid, user, et, ts, prog in rows:
        t = dt.datetime.fromisoformat(ts)
        out.append((eid, user, "movie_1", et, t, t.date(), "TV", f"{user}-{t.date()}", prog))
    return spark.createDataFrame(out, ME_SCHEMA)


def test_conversion_zero_starts(spark):
    me = me_rows(spark, [("e1", "u1", "VIEW_FINISHED", "2024-01-05 10:00:00", 10),
                         ("e2", "u2", "VIEW_FINISHED", "2024-01-05 11:00:00", 20)])
    stored = m.conversion_for_date(me, "2024-01-05").collect()[0]
    assert (stored.started, stored.finished, stored.conversion) == (0, 2, 0.0)
    series = m.conversion_series(me, "2024-01-05 00:00:00", "2024-01-05 23:59:59").collect()
    assert series[0].value is None


def test_metric_upsert_keys(spark):
    day = "2024-01-05"
    first = me_rows(spark, [("e1", "u1", "VIEW_STARTED", "2024-01-05 10:00:00", 0)])
    second = first.unionByName(me_rows(spark, [("e2", "u1", "VIEW_FINISHED", "2024-01-05 12:00:00", 90)]))
    run1, run2 = m.metrics_long(first, day), m.metrics_long(second, day)
    by_default = st.key_merge(run1, run2, ["metric_date", "metric_name", "dimensions"])
    by_name = st.key_merge(run1, run2, ["metric_date", "metric_name"])
    assert by_default.where("metric_name = 'view_conversion'").count() == 2
    assert by_name.where("metric_name = 'view_conversion'").count() == 1


def test_retention_offsets(spark):
    me = me_rows(spark, [("e1", "u1", "LIKED", "2024-01-01 08:00:00", None),
                         ("e2", "u1", "LIKED", "2024-01-01 09:00:00", None),
                         ("e3", "u1", "LIKED", "2024-01-08 09:00:00", None),
                         ("e4", "u1", "LIKED", "2024-01-09 09:00:00", None)])
    rows = r.retention_cohort(me, "2024-01-01").orderBy("day_offset").collect()
    assert [(x.day_offset, x.returned, x.cohort_size) for x in rows] == [(0, 1, 1), (7, 1, 1)]
    heat = r.retention_heatmap(me).collect()[0]
    assert (heat.day_0, heat.day_1, heat.day_7) == (100.0, 0.0, 100.0)


def _promo_frames(spark, code_rows, order_rows):
    promos = spark.createDataFrame(code_rows, "code string, discount_type string, discount_value decimal(12,2), "
                                   "min_order_amount decimal(12,2), max_uses int, current_uses int, "
                                   "valid_from timestamp, valid_until timestamp, active boolean")
    orders = spark.createDataFrame(order_rows, "id long, promo_code string, created_at timestamp")
    totals = spark.createDataFrame([(o[0], 1000) for o in order_rows], "order_id long, total int").select(
        "order_id", F.col("total").cast("decimal(14,2)").alias("total"))
    return orders, totals, promos


def test_promo_discounts(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31)
    codes = [("P70", "PERCENTAGE", D(70), D(0), 10, 0, t0, t1, True),
             ("P71", "PERCENTAGE", D(71), D(0), 10, 0, t0, t1, True),
             ("F1500", "FIXED_AMOUNT", D(1500), D(0), 10, 0, t0, t1, True)]
    orders = [(1, "P70", t0), (2, "P71", t0), (3, "F1500", t1)]   # also: closed validity interval
    o, t, p = _promo_frames(spark, codes, orders)
    got = {x.order_id: (x.reason, float(x.discount), float(x.net)) for x in od.promo_evaluation(o, t, p).collect()}
    assert got == {1: (None, 700.0, 300.0), 2: (None, 0.0, 1000.0), 3: (None, 1000.0, 0.0)}


def test_failure_window(spark):
    codes = ["OK", "UNAVAILABLE", "UNAVAILABLE", "OK", "INTERNAL", "OK", "DEADLINE_EXCEEDED", "OK", "UNAVAILABLE",
             "OK", "UNAVAILABLE"]
    base = dt.datetime(2024, 1, 1)
    calls = spark.createDataFrame([("p", base + dt.timedelta(seconds=i), i, c) for i, c in enumerate(codes)],
                                  "provider string, ts timestamp, call_id long, code string")
    rows = fl.provider_failure_window(calls, 10, 5, chunks=3).orderBy("seq").collect()
    assert [x.window_bad for x in rows[:9]] == [False] * 9
    assert (rows[9].window_bad, rows[9].trips) == (True, False)
    assert (rows[10].window_bad, rows[10].trips) == (True, True)


def test_dedup_ttl_counts_from_kept(spark):
    base = dt.datetime(2024, 1, 1)
    att = spark.createDataFrame(
        [(i, 7, "user_1", "billing", "TRANSACTIONAL", "push", "DELIVERED", base + dt.timedelta(hours=h), 10)
         for i, h in enumerate([0, 23, 25])],
        "attempt_id long, notification_id long, user_id string, source_service string, type string, "
        "channel string, outcome string, ts timestamp, latency_ms long")
    kept = sorted(x.attempt_id for x in nt.dedup_ttl(att).collect())
    assert kept == [0, 2]


def test_failover_ack_cancels(spark):
    base = dt.datetime(2024, 1, 1)
    att = spark.createDataFrame(
        [(1, 100, "push", "DELIVERED", base, 2000), (2, 200, "push", "DELIVERED", base, 9000)],
        "attempt_id long, notification_id long, channel string, outcome string, ts timestamp, latency_ms long")
    out = nt.failover(att, nt.acks_of(att)).collect()
    assert [(x.notification_id, x.next_channel, x.reason) for x in out] == [(200, "sms", "ACK_TIMEOUT")]


def test_contract_reject_and_ingest_defaults(spark):
    lines = spark.createDataFrame([
        ('{"event_id": "", "user_id": "u", "movie_id": "m", "event_type": "VIEW_STARTED", '
         '"timestamp": 0, "device_type": "TV", "session_id": "s"}',),
        ('{"user_id": "u", "movie_id": "m", "event_type": "WATCH_SOMETHING", "device_type": "TV", '
         '"session_id": "s", "progress_seconds": 5}',)], "value string")
    now_ms = F.lit(1_700_000_000_000)
    wire = ev.ingest_json(lines, now_ms=now_ms)
    rows = wire.collect()
    assert rows[0].timestamp == 1_700_000_000_000 and rows[1].timestamp == 1_700_000_000_000
    assert rows[1].event_id is not None and len(rows[1].event_id) == 36    # generated
    checked = qa.event_contract(wire).collect()
    assert checked[0].reasons == "event_id:not_uuid"
    assert checked[1].reasons == "event_type:unknown"


def test_field_fidelity_and_session_of_four(spark):
    base = dt.datetime(2024, 3, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
    ms = int(base.timestamp() * 1000)
    raw = spark.createDataFrame([
        ("aaaaaaaa-0000-4000-8000-000000000001", "test_user_001", "movie_test_001", "VIEW_STARTED", ms, "DESKTOP",
         "sess-1", 0),
        *[(f"aaaaaaaa-0000-4000-8000-00000000010{i}", "u2", "movie_seq_001", et, ms + 1000 * i, "MOBILE", "seq-s", p)
          for i, (et, p) in enumerate([("VIEW_STARTED", 0), ("VIEW_PAUSED", 15), ("VIEW_RESUMED", 15),
                                       ("VIEW_FINISHED", 90)])]],
        "event_id string, user_id string, movie_id string, event_type string, timestamp long, device_type string, "
        "session_id string, progress_seconds int")
    typed = ev.type_events(raw)
    one = typed.where("user_id = 'test_user_001'").collect()[0]
    assert (one.movie_id, one.event_type, one.device_type, one.progress_seconds) == \
        ("movie_test_001", "VIEW_STARTED", "DESKTOP", 0)
    assert one.event_time == base.replace(tzinfo=None)
    stored = ev.with_store_columns(typed)
    audit = qa.session_sequence_audit(stored, chunks=2).where("session_id = 'seq-s'").collect()[0]
    assert (audit.events, audit.starts_ok, audit.progress_falls, audit.after_finish) == (4, True, False, False)


def test_order_payload_rules_array_and_rows_agree(spark):
    from conftest import SF0001
    from marquee.sources import fixtures as fx
    arr = {tuple(r) for r in qa.order_contract_rejects(fx.order_payloads(spark, SF0001)).collect()}
    rows = {tuple(r) for r in qa.order_rows_contract_rejects(fx.order_headers(spark, SF0001),
                                                             fx.order_payload_items(spark, SF0001)).collect()}
    assert arr == rows and arr
