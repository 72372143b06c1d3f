"""Incrementally kept aggregate states.

Four tables hold partial states per day: sketches of the users and the users
themselves (A1), views per movie (A3), sums of watch time (A5).  Each is partitioned by month, as a
``month`` number like 202403, so a range of days reads its months only:

* ``<root>/<table>/batches/batch_id=N/month=M``: the partials of micro-batch N.
  A batch that is run again overwrites what it wrote.
* ``<root>/<table>/folded/fold=N/month=M``: the batches up to N merged to one
  row per key.
* ``<root>/folds/fold=N``: written once all four tables are folded up to N;
  readers take the greatest such N and the batches after it.

A fold only takes batches before the running one (they are committed), writes
aside, commits by that last table and only then removes what it replaced, so
a reader sees every batch once whenever a run breaks off.  What is left of a
broken fold is overwritten or removed by the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as m
from ..operators.store import delete_folders, list_folders, read_if_there

#: Batches after which the closed ones are folded.
FOLD_EVERY = 4


def month_of(day: Column | str) -> Column:
    """Year and month of a date as one number, 202403 for March 2024."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 100 + F.month(day)).alias("month")


def _partials(batch: DataFrame) -> dict[str, DataFrame]:
    return {"daily_users": m.dau_state(batch), "user_days": m.user_days(batch), "movie_views": m.movie_views_state(batch), "watch_time": m.watch_time_state(batch)}


_MERGED = {
    "daily_users": lambda s: s.groupBy("month", "event_date").agg(F.hll_union_agg("uniq_users").alias("uniq_users")),
    "user_days": lambda s: s.select("month", "event_date", "user_id").distinct(),
    "movie_views": lambda s: s.groupBy("month", "event_date", "movie_id").agg(F.sum("views").alias("views")),
    "watch_time": lambda s: s.groupBy("month", "event_date").agg(F.sum("sum_sec").alias("sum_sec"), F.sum("n").alias("n")),
}


def write_partials(batch: DataFrame, root: str, batch_id: int) -> None:
    """The partial states of one micro-batch, replacing those of an earlier run of it."""
    for name, part in _partials(batch).items():
        (part.select(F.lit(batch_id).alias("batch_id"), month_of("event_date"), "*")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "month").parquet(f"{root}/{name}/batches"))


def last_fold(spark: SparkSession, root: str) -> int:
    """The greatest committed fold, -1 without one."""
    folds = read_if_there(spark, f"{root}/folds")
    return -1 if folds is None else folds.agg(F.max("fold")).first()[0]


def state_rows(spark: SparkSession, root: str, name: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The partial rows of a state table, of a range of days if given: each
    batch once, folded or not.  The range also prunes the month folders."""
    fold = last_fold(spark, root)
    parts = [read_if_there(spark, f"{root}/{name}/{kind}") for kind in ("batches", "folded")]
    picked = [p for p in (None if parts[0] is None else parts[0].where(F.col("batch_id") > fold).drop("batch_id"),
                          None if parts[1] is None or fold < 0 else parts[1].where(F.col("fold") == fold).drop("fold")) if p is not None]
    if not picked:
        raise ValueError(f"no states of {name} under {root}")
    rows = picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1])
    for day, side in ((first_day, "__ge__"), (last_day, "__le__")):
        if day is not None:
            d = F.lit(day).cast("date")
            rows = rows.where(getattr(F.col("event_date"), side)(d) & getattr(F.col("month"), side)(F.lit(int(day[:4]) * 100 + int(day[5:7]))))
    return rows


def fold_batches(spark: SparkSession, root: str, upto: int) -> bool:
    """Merge the batches up to ``upto`` and the fold before them into one row
    per key; whether there was anything to fold."""
    before = last_fold(spark, root)
    if upto <= before:
        return False
    for name, merge in _MERGED.items():
        batches = read_if_there(spark, f"{root}/{name}/batches")
        if batches is None:
            return False
        rows = batches.where((F.col("batch_id") > before) & (F.col("batch_id") <= upto)).drop("batch_id")
        if before >= 0:
            rows = rows.unionByName(spark.read.parquet(f"{root}/{name}/folded").where(F.col("fold") == before).drop("fold"))
        merge(rows).write.mode("overwrite").partitionBy("month").parquet(f"{root}/{name}/folded/fold={upto}")
    spark.range(1).select(F.lit(upto).alias("upto")).write.mode("overwrite").parquet(f"{root}/folds/fold={upto}")
    _remove_replaced(spark, root, upto)
    return True


def _remove_replaced(spark: SparkSession, root: str, fold: int) -> None:
    """Batches up to the committed fold and the folds before it."""
    number = lambda path: int(path.rsplit("=", 1)[1])
    for name in _MERGED:
        delete_folders(spark, [p for p in list_folders(spark, f"{root}/{name}/batches", "batch_id=") if number(p) <= fold])
        delete_folders(spark, [p for p in list_folders(spark, f"{root}/{name}/folded", "fold=") if number(p) != fold])
    delete_folders(spark, [p for p in list_folders(spark, f"{root}/folds", "fold=") if number(p) < fold])


def incremental_states(spark: SparkSession, store_path: str, root: str, checkpoint: str, max_files: int = 8, fold_every: int = FOLD_EVERY):
    """Fold the store's micro-batches into the state tables: one run over what is there."""
    schema = spark.read.parquet(store_path).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(store_path)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()          # read once, feeds four tables
        try:
            write_partials(batch, root, batch_id)
        finally:
            batch.unpersist()
        if batch_id % fold_every == fold_every - 1:
            fold_batches(spark, root, batch_id - 1)

    q = src.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def merged_movie_views(spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    return _MERGED["movie_views"](state_rows(spark, root, "movie_views", first_day, last_day)).drop("month")


def merged_watch_time(spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    return _MERGED["watch_time"](state_rows(spark, root, "watch_time", first_day, last_day)).drop("month")


def merged_dau(spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """event_date and the estimate of its users, from sketches alone."""
    return m.dau_state_merge(state_rows(spark, root, "daily_users", first_day, last_day))


def merged_user_days(spark: SparkSession, root: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """event_date and the exact number of its users, from the users of the batches."""
    return m.user_days_merge(state_rows(spark, root, "user_days", first_day, last_day))
