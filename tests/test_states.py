"""Incremental states: batches, folds and months."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from marquee.operators import metrics as m
from marquee.operators.store import list_folders
from marquee.session import scratch_path
from marquee.sources import fixtures as fx
from marquee.streaming import states as ss


def _events(spark):
    """The fixture's events, a third of them a month later."""
    me = fx.movie_events(spark, SF0001)
    later = F.col("event_id").cast("long") % 3 == 0
    return me.withColumn("event_date", F.when(later, F.add_months("event_date", 1)).otherwise(F.col("event_date")))


def _merged(spark, root):
    views = sorted(map(tuple, ss.merged_movie_views(spark, root).collect()))
    watch = sorted(map(tuple, ss.merged_watch_time(spark, root).collect()))
    return views, watch


def _full(me):
    return sorted(map(tuple, m.movie_views_state(me).collect())), sorted(map(tuple, m.watch_time_state(me).collect()))


def test_batches_folds_and_replays(spark):
    root = scratch_path(spark, "states")
    me = _events(spark).cache()
    part = lambda k: me.where(F.pmod(F.xxhash64("event_id"), F.lit(6)) == k)
    for k in range(3):
        ss.write_partials(part(k), root, k)
    ss.write_partials(part(2), root, 2)  # run again: replaces what it wrote
    assert ss.fold_batches(spark, root, 1) and ss.last_fold(spark, root) == 1
    assert not ss.fold_batches(spark, root, 1)
    assert _merged(spark, root) == _full(part(0).unionByName(part(1)).unionByName(part(2)))
    for k in range(3, 6):
        ss.write_partials(part(k), root, k)
    assert ss.fold_batches(spark, root, 4)
    for name in ("daily_users", "movie_views", "watch_time"):
        assert [p.rsplit("/", 1)[1] for p in list_folders(spark, f"{root}/{name}/batches", "batch_id=")] == ["batch_id=5"]
        assert [p.rsplit("/", 1)[1] for p in list_folders(spark, f"{root}/{name}/folded", "fold=")] == ["fold=4"]
    assert _merged(spark, root) == _full(me)
    sketches = ss.state_rows(spark, root, "daily_users").groupBy("event_date").count().agg(F.max("count")).first()[0]
    assert sketches == 2  # one folded, one of the open batch
    assert all(r.within for r in m.dau_within_bound(ss.merged_dau(spark, root), me).collect())


@pytest.mark.parametrize("broken", ["watch_time", "commit", "removal"])
def test_a_broken_fold_loses_and_doubles_nothing(spark, monkeypatch, broken):
    root = scratch_path(spark, "states-broken")
    me = _events(spark).cache()
    for k in range(3):
        ss.write_partials(me.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k), root, k)
    stop = RuntimeError("lost")

    def fail(*_):
        raise stop
    with monkeypatch.context() as patch:
        if broken == "watch_time":
            patch.setitem(ss._MERGED, "watch_time", fail)
        elif broken == "commit":
            patch.setattr(spark, "range", fail)
        else:
            patch.setattr(ss, "_remove_replaced", fail)
        with pytest.raises(RuntimeError):
            ss.fold_batches(spark, root, 1)
    assert _merged(spark, root) == _full(me)
    ss.write_partials(me.limit(0), root, 3)
    ss.fold_batches(spark, root, 2)
    assert ss.last_fold(spark, root) == 2 and _merged(spark, root) == _full(me)


def test_stream_folds_and_prunes_months(spark):
    root = scratch_path(spark, "states-stream")
    me = _events(spark)
    me.repartition(9).write.parquet(f"{root}/store")
    ss.incremental_states(spark, f"{root}/store", f"{root}/states", f"{root}/ckpt", max_files=1)
    assert ss.last_fold(spark, f"{root}/states") == 6  # nine batches, folded at 3 and 7
    assert len(list_folders(spark, f"{root}/states/movie_views/batches", "batch_id=")) == 2
    assert _merged(spark, f"{root}/states") == _full(me)
    first, last = (str(d) for d in me.agg(F.min("event_date"), F.max("event_date")).first())
    rows = ss.state_rows(spark, f"{root}/states", "movie_views", last[:8] + "01", last)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"month#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert {r.month for r in rows.select("month").distinct().collect()} == {int(last[:4]) * 100 + int(last[5:7])} and first[:7] != last[:7]
    want = m.movie_views_state(me.where(F.col("event_date") >= F.lit(last[:8] + "01").cast("date")))
    assert sorted(map(tuple, ss.merged_movie_views(spark, f"{root}/states", last[:8] + "01", last).collect())) == sorted(map(tuple, want.collect()))


def test_month_numbers(spark):
    df = spark.sql("select explode(array(date'2024-03-09', date'1999-12-31', null)) as d")
    assert [r.month for r in df.select(ss.month_of("d")).collect()] == [202403, 199912, None]


def test_no_states(spark):
    with pytest.raises(ValueError, match="no states"):
        ss.state_rows(spark, scratch_path(spark, "none"), "movie_views")


def _many_users(spark):
    """Three days of 20,000 users each, every user on two devices."""
    return spark.range(120000).select(F.concat(F.lit("u"), (F.col("id") % 20000).cast("string")).alias("user_id"),
                                      F.date_add(F.lit("2024-01-30").cast("date"), (F.col("id") % 3).cast("int")).alias("event_date"),
                                      F.when(F.col("id") < 60000, "TV").otherwise("MOBILE").alias("device_type"))


def test_users_of_days_merge_exactly(spark, monkeypatch):
    """F1 of round 3: dau is the count of the merged states, not a bound held against a count beside them."""
    from marquee.plans.catalog import QUERIES
    events = _many_users(spark)
    assert {r.dau for r in m.user_days_merge(m.user_days(events, "device_type")).collect()} == {20000}
    assert all(r.within for r in m.dau_within_bound(m.dau_state_merge(m.dau_state(events, "device_type")), events).collect())
    monkeypatch.setattr(fx, "movie_events", lambda *_: events)
    lossy = m.user_days
    monkeypatch.setattr(m, "user_days", lambda me, *parts: lossy(me.where("user_id <> 'u7'"), *parts))
    got = QUERIES["dau_state_merge"](spark, SF0001)
    assert got.columns == ["event_date", "dau"] and {r.dau for r in got.collect()} == {19999}


def test_users_of_batches_merge_exactly(spark, monkeypatch):
    """F2 of round 3: users seen by several batches count once, folded or not."""
    from marquee.plans import catalog
    root = scratch_path(spark, "states-users")
    events = _many_users(spark).withColumns({"movie_id": F.lit("m"), "event_type": F.lit("VIEW_FINISHED"), "progress_seconds": F.lit(1)})
    ss.write_partials(events.where("device_type = 'TV'"), root, 0)
    ss.write_partials(events.where("device_type = 'MOBILE' and user_id <> 'u7'"), root, 1)
    ss.fold_batches(spark, root, 1)
    ss.write_partials(events.where("user_id < 'u3'"), root, 2)
    assert [(str(r.event_date), r.dau) for r in ss.merged_user_days(spark, root).orderBy("event_date").collect()] == [
        ("2024-01-30", 20000), ("2024-01-31", 20000), ("2024-02-01", 20000)]
    assert [r.dau for r in ss.merged_user_days(spark, root, "2024-02-01").collect()] == [20000]
    assert all(r.within for r in m.dau_within_bound(ss.merged_dau(spark, root), events).collect())
    ss.write_partials(events.limit(0), root, 2)
    monkeypatch.setattr(catalog, "_streamed_states", lambda *_: root)
    got = catalog.QUERIES["incremental_dau"](spark, SF0001)
    assert got.columns == ["event_date", "dau"] and {r.dau for r in got.collect()} == {20000}
