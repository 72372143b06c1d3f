"""The outbox as a change feed."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from marquee.operators import notify as nt
from marquee.session import scratch_path
from marquee.sources import fixtures as fx
from marquee.streaming import feed


def _sorted(df):
    return sorted(map(tuple, df.collect()))


def test_a_growing_outbox_is_published_once(spark, monkeypatch):
    root = scratch_path(spark, "feed")
    paths = f"{root}/outbox", f"{root}/messages", f"{root}/ckpt"
    rows = fx.outbox_changes(spark, SF0001)
    part = lambda k: rows.where(F.pmod("aggregate_id", F.lit(3)) == k)
    assert feed.published(spark, paths[1]) is None
    part(0).repartition(3).write.parquet(paths[0])
    feed.publish_outbox(spark, *paths, max_files=2)
    assert _sorted(feed.published(spark, paths[1])) == _sorted(nt.outbox_messages(part(0)))
    feed.publish_outbox(spark, *paths)  # nothing came
    part(1).write.mode("append").parquet(paths[0])

    write = feed._write_batch

    def breaks(batch, batch_id, sink):
        write(batch, batch_id, sink)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(feed, "_write_batch", breaks)
    with pytest.raises(Exception, match="lost after the write"):
        feed.publish_outbox(spark, *paths)
    monkeypatch.undo()
    part(2).write.mode("append").parquet(paths[0])
    feed.publish_outbox(spark, *paths)  # the broken batch again, then what came since
    assert _sorted(feed.published(spark, paths[1])) == _sorted(nt.outbox_messages(rows))
    assert _sorted(nt.outbox_events(feed.published(spark, paths[1]))) == _sorted(nt.outbox_events(rows))
