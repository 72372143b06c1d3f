"""U4: the daily metric cycle for one date.

Computes the day's metric records, the day's top movies and the retention
of cohorts run-1 and run-7, then applies three upserts -- each one its own
idempotent partition rewrite -- and reports record counts.  The date is a
parameter (default: yesterday UTC); scheduling is left to the caller.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as m
from ..operators import retention as r
from ..operators import store
from ..session import written

METRIC_KEY_DEFAULT = ["metric_date", "metric_name", "dimensions"]
METRIC_KEY_BY_NAME = ["metric_date", "metric_name"]


def _iso(d) -> str:
    return d if isinstance(d, str) else d.isoformat()


def day_slice(me: DataFrame, day) -> DataFrame:
    return me.where(F.col("event_date") == F.lit(_iso(day)).cast("date"))


def cycle_frames_for_date(me: DataFrame, day, computed_at, top_n: int = 10, max_day_offset: int = 7):
    """(metrics, top, retention) DataFrames of the cycle for ``day``.
    ``computed_at`` is a timestamp column or literal text."""
    stamp = F.lit(computed_at).cast("timestamp") if isinstance(computed_at, str) else computed_at
    metrics = m.metrics_long(me, day).withColumn("computed_at", stamp)
    top = m.top_movies_daily(m.movie_views_state(day_slice(me, day)), day, top_n).withColumn("computed_at", stamp)
    retention = r.retention_for_run(me, day, max_day_offset).withColumn("computed_at", stamp)
    return metrics, top, retention


def cycle_activity(me: DataFrame, day, max_day_offset: int = 7) -> DataFrame:
    """What the cycle of ``day`` needs of the events, in one aggregate: the
    active days per user up to the last one that a refreshed cohort looks at
    and, on ``day`` itself, the counts per (user, movie)."""
    run = dt.date.fromisoformat(_iso(day))
    last = max(run, run - dt.timedelta(days=1) + dt.timedelta(days=max_day_offset))
    today = F.col("event_date") == F.lit(_iso(day)).cast("date")
    finished = F.col("event_type") == m.FINISHED
    watched = today & finished & F.col("progress_seconds").isNotNull()
    return (me.where(F.col("event_date") <= F.lit(last.isoformat()).cast("date"))
            .groupBy("event_date", "user_id", F.when(today, F.col("movie_id")).alias("movie_id"))
            .agg(F.count_if(today & (F.col("event_type") == m.STARTED)).alias("started"), F.count_if(today & finished).alias("finished"),
                 F.sum(F.when(watched, F.col("progress_seconds"))).cast("double").alias("sum_sec"), F.count_if(watched).alias("n_fin")))


def frames_of_activity(activity: DataFrame, day, computed_at, top_n: int = 10, max_day_offset: int = 7):
    """``cycle_frames_for_date`` from the rows of ``cycle_activity``."""
    stamp = F.lit(computed_at).cast("timestamp") if isinstance(computed_at, str) else computed_at
    today = day_slice(activity, day)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    sums = today.agg(F.count_distinct("user_id").alias("dau"), F.sum("sum_sec").alias("sum_sec"), total("n_fin"), total("started"), total("finished"))
    metrics = m.long_form(sums, F.lit(_iso(day)).cast("date")).withColumn("computed_at", stamp)
    views = today.where("started > 0").select("event_date", "movie_id", F.col("started").alias("views"))
    top = m.top_movies_daily(views, day, top_n).withColumn("computed_at", stamp)
    retention = r.retention_for_run(activity, day, max_day_offset).withColumn("computed_at", stamp)
    return metrics, top, retention


def daily_cycle(spark: SparkSession, me: DataFrame, root: str, day=None, computed_at=None,
                metric_key: list[str] | None = None, top_n: int = 10) -> dict:
    """Run the cycle and upsert into ``root``/{metrics_daily, top_movies_daily,
    retention_cohort}.  The events are read once: their activity is written
    aside and feeds all three.  Returns the tables and elapsed seconds."""
    import time
    t0 = time.time()
    day = _iso(day or m.yesterday_utc())
    stamp = F.current_timestamp() if computed_at is None else computed_at
    activity = written(cycle_activity(me, day), "cycle-activity")
    metrics, top, retention = frames_of_activity(activity, day, stamp, top_n)
    mt = store.upsert_table(spark, f"{root}/metrics_daily", metrics, metric_key or METRIC_KEY_DEFAULT,
                            "metric_date")
    tt = store.upsert_table(spark, f"{root}/top_movies_daily", top, ["metric_date"], "metric_date", replace=[day])
    rt = store.upsert_table(spark, f"{root}/retention_cohort", retention, ["cohort_date", "day_offset"],
                            "cohort_date")
    return {"date": day, "tables": (mt, tt, rt), "elapsed_sec": round(time.time() - t0, 3)}


def cycle_rows(tables, day) -> DataFrame:
    """What the cycle left for the run date, table by table: section, name,
    value, place (rank or day offset), views or returned users, cohort size."""
    mt, tt, rt = tables
    d = F.lit(_iso(day)).cast("date")
    dd = dt.date.fromisoformat(_iso(day))
    cohorts = [F.lit((dd - dt.timedelta(days=k)).isoformat()).cast("date") for k in (1, 7)]
    none = F.lit(None).cast("long")
    return (mt.where(F.col("metric_date") == d)
            .select(F.lit("metrics").alias("section"), F.col("metric_name").alias("name"),
                    F.col("metric_value").alias("value"), none.alias("place"), none.alias("n"), none.alias("size"),
                    F.col("dimensions").alias("dimensions"))
            .unionByName(tt.where(F.col("metric_date") == d)
                         .select(F.lit("top").alias("section"), F.col("movie_id").alias("name"),
                                 F.lit(None).cast("double").alias("value"), F.col("rank").cast("long").alias("place"),
                                 F.col("views").cast("long").alias("n"), none.alias("size"),
                                 F.lit(None).cast("string").alias("dimensions")))
            .unionByName(rt.where(F.col("cohort_date").isin(cohorts))
                         .select(F.lit("retention").alias("section"),
                                 F.date_format("cohort_date", "yyyy-MM-dd").alias("name"),
                                 F.col("retention_pct").alias("value"), F.col("day_offset").cast("long").alias("place"),
                                 F.col("returned").cast("long").alias("n"), F.col("cohort_size").cast("long").alias("size"),
                                 F.lit(None).cast("string").alias("dimensions"))))
