"""Sources and sinks: publish frames, request log, store layout and TTL,
idempotent exports."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001
from marquee.operators import export as ex
from marquee.operators import store as st
from marquee.session import scratch_path
from marquee.sources import events as ev
from marquee.sources import fixtures as fx


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_publish_frames_shape(spark):
    frames = ev.publish_frames(fx.raw_event_rows(spark, SF001).limit(5))
    assert frames.columns == ["key", "value", "headers"]
    row = frames.collect()[0]
    assert bytes(row.key).decode().startswith("user_")
    assert [h.key for h in row.headers] == ["event_type", "event_id"]


def test_request_log_masking(spark):
    lines = spark.createDataFrame([
        ('{"request_id": "r1", "method": "POST", "endpoint": "/login", "status_code": 200, "duration_ms": 12, '
         '"timestamp": "2024-01-01T00:00:00", "body": {"password": "x", "a": 1}}',),
        ('{"request_id": "r2", "method": "GET", "endpoint": "/x", "status_code": 500, "duration_ms": 40, '
         '"timestamp": "2024-01-01T00:00:01", "body": "not json"}',)], "value string")
    log = ev.parse_request_log(lines).orderBy("request_id").collect()
    assert log[0].body_masked == {"password": "***", "a": "1"}
    assert log[1].body_masked is None
    stats = ev.request_stats(ev.parse_request_log(lines)).collect()
    assert sorted((s.endpoint, s.n) for s in stats) == [("/login", 1), ("/x", 1)]


def test_raw_store_partition_pruning_and_ttl(spark):
    path = scratch_path(spark, "store-test")
    stored = ev.with_store_columns(ev.type_events(fx.raw_event_rows(spark, SF001)))
    st.append_raw_events(stored, path)
    back = st.read_raw_events(spark, path).where(F.col("event_date") == F.lit("2024-01-10").cast("date"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-10" in plan
    assert back.count() == stored.where("event_date = DATE'2024-01-10'").count()
    n_days = len([d for d in os.listdir(local(path)) if d.startswith("event_date=")])
    dropped = st.drop_expired_days(spark, path, "2024-04-20", 90)
    left = len([d for d in os.listdir(local(path)) if d.startswith("event_date=")])
    assert dropped > 0 and left == n_days - dropped
    assert st.read_raw_events(spark, path).agg(F.min("event_date")).collect()[0][0] > dt.date(2024, 1, 21)


def _tables(spark):
    me = fx.movie_events(spark, SF001)
    from marquee.plans import daily_cycle as dc
    return dc.cycle_frames_for_date(me, "2024-01-08", "2024-01-09 00:05:00")


def test_export_idempotent_and_empty(spark):
    root = scratch_path(spark, "export-test")
    m, t, r = _tables(spark)
    for fmt in ("csv", "json", "parquet"):
        p1 = ex.write_export(m, t, r, "2024-01-08", fmt, root)
        p2 = ex.write_export(m, t, r, "2024-01-08", fmt, root)
        assert p1 == p2
    back = spark.read.parquet(ex.export_path(root, "2024-01-08", "parquet"))
    assert back.columns == ex.EXPORT_COLUMNS and back.count() == 3 + 10
    # a day without rows still writes its file
    p = ex.write_export(m, t, r, "2023-06-01", "csv", root)
    assert os.path.isfile(local(p)) and spark.read.option("header", True).csv(p).count() == 0
    assert sorted(n for n in os.listdir(os.path.dirname(local(p))) if not n.startswith(".")) == ["aggregates.csv"]
    try:
        ex.export_path(root, "2024-01-08", "xml")
        assert False
    except ValueError:
        pass


def test_upsert_table_twice_is_idempotent(spark):
    root = scratch_path(spark, "upsert-test")
    m, _, _ = _tables(spark)
    a = st.upsert_table(spark, f"{root}/metrics", m, ["metric_date", "metric_name", "dimensions"], "metric_date")
    first = sorted(map(tuple, a.collect()))
    b = st.upsert_table(spark, f"{root}/metrics", m, ["metric_date", "metric_name", "dimensions"], "metric_date")
    assert sorted(map(tuple, b.collect())) == first


def test_observed_publish_count(spark):
    frames = ev.publish_frames(fx.raw_event_rows(spark, SF001))
    counted, obs = ev.observe_published(frames)
    counted.write.format("noop").mode("overwrite").save()
    assert obs.get["published"] == fx.movie_events(spark, SF001).count()


def test_replaced_days_may_be_read_by_their_replacement(spark):
    """``new`` is computed from the table it replaces; a value without a new row ends empty."""
    from marquee.operators import store as st
    from marquee.session import scratch_path
    path = scratch_path(spark, "replace-self")
    rows = [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02"), (4, "d", "2024-01-03")]
    first = spark.createDataFrame(rows, "n int, k string, day string").selectExpr("n", "k", "cast(day as date) as day")
    st.upsert_table(spark, path, first, ["k"], "day")
    table = spark.read.parquet(path)
    new = table.where("k <> 'd'").selectExpr("n * 10 as n", "k", "day")
    got = st.upsert_table(spark, path, new, ["day"], "day", replace=["2024-01-01", "2024-01-03"])
    assert sorted((r.n, r.k, str(r.day)) for r in got.collect()) == [(3, "c", "2024-01-02"), (10, "a", "2024-01-01"), (20, "b", "2024-01-01")]


def test_a_failed_replacement_leaves_the_table(spark):
    import pytest
    from pyspark.sql import functions as F

    from marquee.operators import store as st
    from marquee.session import scratch_path
    path = scratch_path(spark, "replace-fails")
    first = spark.createDataFrame([(1, "a")], "n int, k string").withColumn("day", F.lit("2024-01-01").cast("date"))
    st.upsert_table(spark, path, first, ["k"], "day")
    broken = first.withColumn("n", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        st.upsert_table(spark, path, broken, ["k"], "day", replace=["2024-01-01"]).collect()
    assert spark.read.parquet(path).count() == 1
