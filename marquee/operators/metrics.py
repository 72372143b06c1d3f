"""Daily event metrics: mergeable partial states, per-date merges, dashboard
series, top-N, device share and the long-form metric record set.

All inputs are stored-form movie events (``me``).  Every aggregate is a
plain ``groupBy`` so Spark runs partial aggregation before the shuffle; a
hot user, movie or day collapses map-side to one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STARTED = "VIEW_STARTED"
FINISHED = "VIEW_FINISHED"

# Fixed thresholds of the dashboard colour bands.
RETENTION_BANDS = [(60, "green"), (40, "yellow"), (25, "orange"), (10, "red")]
RETENTION_BASE_BAND = "dark-red"
CONVERSION_BANDS = [(0.5, "green"), (0.3, "yellow")]
CONVERSION_BASE_BAND = "red"


def _date(d) -> Column:
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def in_range(ts_col: str, start, end) -> Column:
    """Dashboard time filter: both ends inclusive.  The day bounds let the
    day-partitioned store skip folders; the time bounds are exact."""
    lo, hi = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    return (F.col("event_date").between(lo.cast("date"), hi.cast("date"))
            & (F.col(ts_col) >= lo) & (F.col(ts_col) <= hi))


# ----------------------------------------------------------- partial states

#: Registers of a sketch, as a power of two; its standard error is 1.04 / sqrt(registers).
SKETCH_BITS = 12


def dau_state(me: DataFrame, *parts: str) -> DataFrame:
    """A1: mergeable HLL sketches of user ids, one per day (and value of
    ``parts``, where partial states are wanted)."""
    return me.groupBy("event_date", *parts).agg(F.hll_sketch_agg("user_id", SKETCH_BITS).alias("uniq_users"))


def dau_state_merge(state: DataFrame) -> DataFrame:
    """A1/A2 approximate form: union the sketches of a day and estimate."""
    return (state.groupBy("event_date")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("uniq_users")).alias("dau")))


def user_days(me: DataFrame, *parts: str) -> DataFrame:
    """A1 exact form: the users of each day (and value of ``parts``) as rows,
    which merge by union."""
    return me.select("event_date", *parts, "user_id").distinct()


def user_days_merge(state: DataFrame) -> DataFrame:
    """A1/A2 exact form: users per day over all partial states."""
    return state.groupBy("event_date").agg(F.count_distinct("user_id").alias("dau"))


def dau_within_bound(estimates: DataFrame, me: DataFrame, errors: float = 4.0) -> DataFrame:
    """Estimates held against the exact counts: event_date, dau (exact),
    within (the estimate is off by at most ``errors`` standard errors, or by
    one user)."""
    exact = me.groupBy("event_date").agg(F.count_distinct("user_id").alias("exact"))
    bound = F.greatest(F.lit(1.0), F.col("exact") * (errors * 1.04 / 2 ** (SKETCH_BITS / 2)))
    return exact.join(estimates, "event_date", "full_outer").select(
        "event_date", F.col("exact").alias("dau"), F.coalesce(F.abs(F.col("dau") - F.col("exact")) <= bound, F.lit(False)).alias("within"))


def movie_views_state(me: DataFrame) -> DataFrame:
    """A3: views per (day, movie) over VIEW_STARTED events."""
    return (me.where(F.col("event_type") == STARTED)
            .groupBy("event_date", "movie_id").agg(F.count(F.lit(1)).alias("views")))


def watch_time_state(me: DataFrame) -> DataFrame:
    """A5: (sum, count) of progress over finished views, per day."""
    return (me.where((F.col("event_type") == FINISHED) & F.col("progress_seconds").isNotNull())
            .groupBy("event_date")
            .agg(F.sum("progress_seconds").cast("long").alias("sum_sec"),
                 F.count("progress_seconds").alias("n")))


# ------------------------------------------------------- merges for one date

def dau_for_date(me: DataFrame, day) -> DataFrame:
    """A2 exact: distinct users of the day, 0 when the day has no events."""
    return (me.where(F.col("event_date") == _date(day))
            .agg(F.count_distinct("user_id").alias("dau"))
            .select(_date(day).alias("event_date"), "dau"))


def avg_watch_time_for_date(state: DataFrame, day) -> DataFrame:
    """Merged mean over the (sum, count) state; 0.0 when there is none."""
    s = state.where(F.col("event_date") == _date(day)).agg(
        F.sum("sum_sec").alias("s"), F.sum("n").alias("c"))
    return s.select(
        _date(day).alias("metric_date"),
        F.coalesce(F.try_divide(F.col("s").cast("double"), F.col("c")), F.lit(0.0)).alias("avg_watch_time_sec"))


def conversion_for_date(me: DataFrame, day) -> DataFrame:
    """finished/started for the day; 0.0 when nothing started."""
    c = (me.where(F.col("event_date") == _date(day))
         .agg(F.count_if(F.col("event_type") == STARTED).alias("started"),
              F.count_if(F.col("event_type") == FINISHED).alias("finished")))
    return c.select(
        _date(day).alias("metric_date"), "started", "finished",
        F.when(F.col("started") > 0, F.col("finished") / F.col("started")).otherwise(F.lit(0.0)).alias("conversion"))


def top_movies_daily(views_state: DataFrame, day, n: int = 10) -> DataFrame:
    """A4: top-n movies of a day from the views state, ranked 1..n: the
    per-day ranking of ``top_movies_by_day`` over that day's state, so the
    rank window is keyed by the day and a partial ``WindowGroupLimit``
    keeps n rows per task before the shuffle."""
    return top_movies_by_day(views_state.where(F.col("event_date") == _date(day)), n)


def top_movies_by_day(views_state: DataFrame, n: int = 10) -> DataFrame:
    """Top-n per day for every day of the state (per-day window, bounded by
    the catalogue size of one day)."""
    per = views_state.groupBy("event_date", "movie_id").agg(F.sum("views").alias("views"))
    w = Window.partitionBy("event_date").orderBy(F.desc("views"), F.asc("movie_id"))
    return (per.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= n)
            .select(F.col("event_date").alias("metric_date"), "movie_id", "rank", "views"))


# --------------------------------------------------------- dashboard series

def conversion_series(me: DataFrame, start, end) -> DataFrame:
    """Per-day conversion, NULL when the day has no starts."""
    return (me.where(in_range("event_time", start, end)).groupBy("event_date")
            .agg((F.count_if(F.col("event_type") == FINISHED)
                  / F.nullif(F.count_if(F.col("event_type") == STARTED), F.lit(0))).alias("value")))


def dau_series(me: DataFrame, start, end) -> DataFrame:
    """Exact distinct users per day over the range of days."""
    d = F.col("event_date").cast("timestamp")
    return (me.where((d >= F.lit(str(start)).cast("timestamp")) & (d <= F.lit(str(end)).cast("timestamp")))
            .groupBy("event_date").agg(F.count_distinct("user_id").alias("value")))


def watch_time_series(state: DataFrame, start, end) -> DataFrame:
    """A10: mean watch seconds per day from the (sum, count) state."""
    d = F.col("event_date").cast("timestamp")
    return (state.where((d >= F.lit(str(start)).cast("timestamp")) & (d <= F.lit(str(end)).cast("timestamp")))
            .groupBy("event_date")
            .agg((F.sum("sum_sec").cast("double") / F.sum("n")).alias("value")))


def top_movies_range(me: DataFrame, start, end, n: int = 10) -> DataFrame:
    """Most started movies over an arbitrary time range."""
    return (me.where((F.col("event_type") == STARTED) & in_range("event_time", start, end))
            .groupBy("movie_id").agg(F.count(F.lit(1)).alias("views"))
            .orderBy(F.desc("views"), F.asc("movie_id")).limit(n))


def device_share(me: DataFrame, start, end) -> DataFrame:
    """Events per device and share of all events in the range.  The
    total is a scalar subquery over the per-device rows (its shuffle is
    reused), so nothing runs as an unpartitioned window."""
    per = (me.where(in_range("event_time", start, end))
           .groupBy("device_type").agg(F.count(F.lit(1)).alias("events")))
    return per.withColumn("share", F.col("events") / per.agg(F.sum("events")).scalar())


def events_by_type(me: DataFrame) -> DataFrame:
    """Events per type, ordered by type."""
    return me.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy("event_type")


def latest_metrics(metrics: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` metric rows by date (newest first), then name;
    dimensions and computed_at break ties so the cut is deterministic."""
    return metrics.orderBy(F.desc("metric_date"), "metric_name", "dimensions", "computed_at").limit(n)


def conversion_last(series: DataFrame) -> DataFrame:
    """P10: last non-null value of a per-day series, with its colour band."""
    last = (series.where(F.col("value").isNotNull())
            .agg(F.max_by(F.struct("event_date", "value"), "event_date").alias("last"))
            .where(F.col("last").isNotNull())
            .select(F.col("last.event_date").alias("event_date"), F.col("last.value").alias("conversion")))
    return last.withColumn("band", band(F.col("conversion"), CONVERSION_BANDS, CONVERSION_BASE_BAND))


def band(value: Column, steps, base: str) -> Column:
    """Threshold banding: the highest step whose value is reached."""
    expr = None
    for threshold, name in steps:
        expr = (F.when(value >= threshold, name) if expr is None else expr.when(value >= threshold, name))
    return expr.otherwise(base)


# -------------------------------------------------------- long metric record

def _day_aggs():
    fin = (F.col("event_type") == FINISHED) & F.col("progress_seconds").isNotNull()
    return [F.count_distinct("user_id").alias("dau"),
            F.sum(F.when(fin, F.col("progress_seconds"))).cast("double").alias("sum_sec"),
            F.count_if(fin).alias("n_fin"),
            F.count_if(F.col("event_type") == STARTED).alias("started"),
            F.count_if(F.col("event_type") == FINISHED).alias("finished")]


def long_form(m: DataFrame, date_col: Column) -> DataFrame:
    """A14 rows of one row of sums per day: dau, sum_sec, n_fin, started, finished."""
    dims = F.to_json(F.struct(F.col("finished").alias("finished"), F.col("started").alias("started")))
    avg = F.coalesce(F.try_divide(F.col("sum_sec"), F.col("n_fin")), F.lit(0.0))
    conv = F.when(F.col("started") > 0, F.col("finished") / F.col("started")).otherwise(F.lit(0.0))
    stacked = m.select(date_col.alias("metric_date"), F.explode(F.array(
        F.struct(F.lit("dau").alias("metric_name"), F.col("dau").cast("double").alias("metric_value"),
                 F.lit("{}").alias("dimensions")),
        F.struct(F.lit("avg_watch_time_sec").alias("metric_name"), avg.alias("metric_value"),
                 F.lit("{}").alias("dimensions")),
        F.struct(F.lit("view_conversion").alias("metric_name"), conv.alias("metric_value"),
                 dims.alias("dimensions")),
    )).alias("m"))
    return stacked.select("metric_date", "m.metric_name", "m.metric_value", "m.dimensions")


def metrics_long(me: DataFrame, day) -> DataFrame:
    """(metric_date, metric_name, metric_value, dimensions) for dau,
    avg_watch_time_sec and view_conversion of one day, in one pass over the
    day slice; an empty day still yields its three rows (0, 0.0, 0.0).
    Dimensions are JSON with sorted keys."""
    m = me.where(F.col("event_date") == _date(day)).agg(*_day_aggs())
    return long_form(m, _date(day))


def metrics_long_by_day(me: DataFrame) -> DataFrame:
    """A14 for every day present in ``me`` (one grouped pass)."""
    m = me.groupBy("event_date").agg(*_day_aggs())
    return long_form(m, F.col("event_date"))


def yesterday_utc(today: dt.date | None = None) -> dt.date:
    today = today or dt.datetime.now(dt.timezone.utc).date()
    return today - dt.timedelta(days=1)
