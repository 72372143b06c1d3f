"""U4: one aggregate of the events feeds the three results of a cycle."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from marquee.plans import daily_cycle as dc
from marquee.session import scratch_path, written
from marquee.sources import fixtures as fx


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("day", ["2024-01-08", "2024-01-02", "2031-01-01"])
def test_one_aggregate_gives_the_same_frames(spark, day):
    me = fx.movie_events(spark, SF0001)
    n = F.col("event_id").cast("long")
    me = me.withColumn("user_id", F.when(n % 17 > 0, F.col("user_id"))).withColumn("movie_id", F.when(n % 13 > 0, F.col("movie_id")))
    stamp = "2024-01-09 00:05:00"
    activity = written(dc.cycle_activity(me, day), "activity")
    for got, want in zip(dc.frames_of_activity(activity, day, stamp), dc.cycle_frames_for_date(me, day, stamp), strict=True):
        assert got.dtypes == want.dtypes
        assert _rows(got) == _rows(want)


def test_the_cycle_reads_the_events_once(spark, monkeypatch):
    """The aggregate has one scan, and the tables are made of what it wrote."""
    me = fx.movie_events(spark, SF0001)
    plan = dc.cycle_activity(me, "2024-01-08")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    seen = []
    upsert = dc.store.upsert_table
    monkeypatch.setattr(dc.store, "upsert_table", lambda s, path, new, *a, **k: (seen.append(new), upsert(s, path, new, *a, **k))[1])
    dc.daily_cycle(spark, me, scratch_path(spark, "cycle"), "2024-01-08", "2024-01-09 00:05:00")
    events = set(me.inputFiles())
    assert len(seen) == 3 and not any(events & set(df.inputFiles()) for df in seen)
