"""Cohort retention.

A user's cohort is the day of their first event in the retained store.  The
plan never joins events back to a cohort table: it reduces events to
distinct (user, day) pairs -- partial aggregation collapses a hot user to a
handful of rows per task -- and takes the first day with a window
partitioned by user, so the only data that crosses the second shuffle is
one row per active user-day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .metrics import RETENTION_BANDS, RETENTION_BASE_BAND, band


def _d(day) -> str:
    return day if isinstance(day, str) else day.isoformat()


def first_activity(me: DataFrame) -> DataFrame:
    """First activity day per user."""
    return me.groupBy("user_id").agg(F.min("event_date").alias("cohort_date"))


def user_day_offsets(me: DataFrame, max_day_offset: int = 7) -> DataFrame:
    """(user_id, cohort_date, day_offset) for every active day within
    ``max_day_offset`` days of the user's first day (J1 + J2)."""
    user_days = me.select("user_id", "event_date").distinct()
    first = F.min("event_date").over(Window.partitionBy("user_id"))
    return (user_days.withColumn("cohort_date", first)
            .withColumn("day_offset", F.datediff("event_date", "cohort_date"))
            .where(F.col("day_offset").between(0, max_day_offset))
            .select("user_id", "cohort_date", "day_offset"))


def _rates(offsets: DataFrame) -> DataFrame:
    """Retention rows of (cohort_date, day_offset) user rows: only offsets with activity.

    The cohort size is the offset-0 count (every user is active on their
    first day), taken with a window over at most max_day_offset+1 rows per cohort."""
    counts = offsets.groupBy("cohort_date", "day_offset").agg(F.count(F.lit(1)).alias("returned"))
    size = F.max(F.when(F.col("day_offset") == 0, F.col("returned"))).over(Window.partitionBy("cohort_date"))
    return (counts.withColumn("cohort_size", size)
            .select("cohort_date", F.col("day_offset").cast("int").alias("day_offset"),
                    F.col("cohort_size").cast("int").alias("cohort_size"),
                    F.col("returned").cast("int").alias("returned"),
                    (F.col("returned") / F.col("cohort_size")).alias("retention_pct")))


def retention_all_cohorts(me: DataFrame, max_day_offset: int = 7) -> DataFrame:
    """C1 over every cohort."""
    return _rates(user_day_offsets(me, max_day_offset))


def retention_of(me: DataFrame, cohort_dates: list, max_day_offset: int = 7) -> DataFrame:
    """C1 for given cohort dates.  First days need the history up to the
    latest cohort only, activity the days from the earliest cohort to
    ``max_day_offset`` after the latest; both are filters on the day column,
    and only the cohorts' own users are joined to their days."""
    dates = sorted(_d(c) for c in cohort_dates)
    day = lambda text: F.lit(text).cast("date")
    joined = (first_activity(me.where(F.col("event_date") <= day(dates[-1])))
              .where(F.col("cohort_date").isin([day(c) for c in dates])))
    last = (dt.date.fromisoformat(dates[-1]) + dt.timedelta(days=max_day_offset)).isoformat()
    seen = me.where(F.col("event_date").between(day(dates[0]), day(last))).select("user_id", "event_date").distinct()
    offset = F.datediff("event_date", "cohort_date")
    return _rates(seen.join(joined, "user_id").withColumn("day_offset", offset)
                  .where(F.col("day_offset").between(0, max_day_offset)))


def retention_cohort(me: DataFrame, cohort_date, max_day_offset: int = 7) -> DataFrame:
    """Retention of one cohort date as a fraction 0..1."""
    return retention_of(me, [cohort_date], max_day_offset)


def retention_for_run(me: DataFrame, run_date, max_day_offset: int = 7) -> DataFrame:
    """The cohorts a run for ``run_date`` refreshes (run-1 and run-7)."""
    run = dt.date.fromisoformat(_d(run_date))
    return retention_of(me, [run - dt.timedelta(days=k) for k in (1, 7)], max_day_offset)


def retention_heatmap(me: DataFrame, limit: int = 30, max_day_offset: int = 7) -> DataFrame:
    """Newest ``limit`` cohorts, Day 0..Day N as rounded percent (0 where none)."""
    offs = user_day_offsets(me, max_day_offset)
    aggs = [F.count_if(F.col("day_offset") == k).alias(f"n_{k}") for k in range(max_day_offset + 1)]
    per = offs.groupBy("cohort_date").agg(*aggs)
    cols = [F.round(100 * F.col(f"n_{k}") / F.col("n_0"), 0).alias(f"day_{k}") for k in range(max_day_offset + 1)]
    return (per.orderBy(F.desc("cohort_date")).limit(limit)
            .select(F.date_format("cohort_date", "yyyy-MM-dd").alias("cohort_date"), *cols))


def retention_bands(retention: DataFrame) -> DataFrame:
    """Colour band of each retention row (percent thresholds)."""
    return retention.withColumn("band", band(F.col("retention_pct") * 100, RETENTION_BANDS, RETENTION_BASE_BAND))
