"""Invariants over whole registered query outputs."""

from pyspark.sql import functions as F

from conftest import SF001, SF0001
from marquee.plans import params as P
from marquee.plans.catalog import QUERIES
from marquee.operators import retention as r
from marquee.sources import fixtures as fx


def test_retention_bounded_by_cohort(spark):
    ret = r.retention_all_cohorts(fx.movie_events(spark, SF001), P.MAX_DAY_OFFSET)
    assert ret.count() > 0
    assert ret.where(F.col("returned") > F.col("cohort_size")).count() == 0
    assert ret.where((F.col("day_offset") == 0) & (F.col("returned") != F.col("cohort_size"))).count() == 0
    assert ret.where(~F.col("retention_pct").between(0, 1)).count() == 0


def test_device_events_sum_to_total(spark):
    share = QUERIES["device_share"](spark, SF001)
    me = fx.movie_events(spark, SF001)
    total = me.where(F.col("event_time").between(F.lit(P.RANGE_START).cast("timestamp"),
                                                 F.lit(P.RANGE_END).cast("timestamp"))).count()
    row = share.agg(F.sum("events").alias("n"), F.sum("share").alias("s")).first()
    assert row.n == total
    assert abs(row.s - 1.0) < 1e-4


def flights(spark):
    from marquee.sources import fixtures as fx
    return fx.flights(spark, SF0001).select(F.col("id").alias("flight_id"))


def test_seats_never_negative(spark):
    res = QUERIES["seat_reservation"](spark, SF0001)
    assert res.count() > 0
    assert res.where(F.col("remaining") < 0).count() == 0
    # a booking that has its reservation is answered EXISTING before its flight is looked up, also on an unknown one
    assert res.where(F.col("remaining").isNull() & ~F.col("status").isin("NOT_FOUND", "EXISTING")).count() == 0
    assert res.where(F.col("remaining").isNull() & (F.col("status") == "EXISTING")).join(flights(spark), "flight_id").count() == 0


def test_discount_within_total(spark):
    d = QUERIES["promo_discounts"](spark, SF001)
    assert d.count() > 0
    assert d.where((F.col("discount") < 0) | (F.col("discount") > F.col("total"))).count() == 0
    assert d.where(F.abs(F.col("net") - (F.col("total") - F.col("discount"))) > 0.005).count() == 0


def test_dau_sketches_merge_across_partial_states(spark):
    from marquee.operators import metrics as m
    me = fx.movie_events(spark, SF001)
    # two partial states over disjoint event halves, as two inserts would leave them
    half = F.substring(F.sha2(F.col("event_id"), 256), 1, 1) < "8"
    states = m.dau_state(me.where(half)).unionByName(m.dau_state(me.where(~half)))
    est = {r.event_date: r.dau for r in m.dau_state_merge(states).collect()}
    exact = {r.event_date: r.n for r in me.groupBy("event_date").agg(F.count_distinct("user_id").alias("n")).collect()}
    assert est.keys() == exact.keys()
    for d, n in exact.items():
        assert abs(est[d] - n) <= max(1, 0.02 * n)
