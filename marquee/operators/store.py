"""The raw event store and key-merged metric tables on plain Parquet.

* S3: append typed events into a day-partitioned table, each batch's files
  sorted by (event_type, user_id, event_time) so row-group statistics skip;
  rewriting whole days is a call of its own.
* S4: 90-day retention as a filter (and as dropping old day folders).
* U1/U3: key-merge upserts; U2: replace given days, even with nothing.
* Overwrites name dynamic partition overwrite as a write option, so they
  never depend on the session: only the partitions written are replaced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

STORE_SORT = ["event_date", "event_type", "user_id", "event_time"]


def _spread(stored: DataFrame, files_per_day_hint: int | None):
    """Range-partition on the full sort key (so a hot day or user is split
    across tasks by time) and sort inside each task.  The task count comes
    from AQE (shuffle partitions coalesced to the advisory size) unless
    ``files_per_day_hint`` fixes it."""
    keys = [F.col(c) for c in STORE_SORT]
    spread = stored.repartitionByRange(files_per_day_hint, *keys) if files_per_day_hint \
        else stored.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*STORE_SORT).write.partitionBy("event_date")


def append_raw_events(stored: DataFrame, path: str, files_per_day_hint: int | None = None) -> None:
    """S3: add a batch of typed events to the store; rows of earlier batches
    of the same days stay (repeated deliveries are for T3 to drop)."""
    _spread(stored, files_per_day_hint).mode("append").parquet(path)


def rewrite_raw_days(stored: DataFrame, path: str, files_per_day_hint: int | None = None) -> None:
    """Replace the days that ``stored`` holds (a re-run of whole days); other days stay."""
    _spread(stored, files_per_day_hint).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ttl_filter(me: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Keep event days younger than ``days`` at ``as_of`` (a parameter,
    never the wall clock).  On the day-partitioned store this is a
    partition filter, so expired days are never listed or read."""
    as_of = as_of if isinstance(as_of, str) else as_of.isoformat()
    cut = F.date_sub(F.lit(as_of).cast("date"), days)
    return me.where(F.col("event_date") > cut)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path: Spark has no call of its own to list or
    drop a folder (a classic session is needed, not a Connect one)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Partition folders under ``path`` (names only; no data is read)."""
    fs, hpath = _file_system(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(hpath) if st.getPath().getName().startswith(prefix))


def delete_folders(spark: SparkSession, paths: list[str]) -> int:
    for path in paths:
        fs, hpath = _file_system(spark, path)
        fs.delete(hpath, True)
    return len(paths)


def put_in_place(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, replacing the file that is at ``target``."""
    jvm = spark.sparkContext._jvm
    _, path = _file_system(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(source), path, options)


def expired_days(spark: SparkSession, path: str, as_of, days: int = 90) -> list[str]:
    """Day folders of the store that the TTL removes."""
    as_of_d = dt.date.fromisoformat(as_of if isinstance(as_of, str) else as_of.isoformat())
    cut = as_of_d - dt.timedelta(days=days)
    return [p for p in list_folders(spark, path, "event_date=") if dt.date.fromisoformat(p.rsplit("=", 1)[1]) <= cut]


def drop_expired_days(spark: SparkSession, path: str, as_of, days: int = 90) -> int:
    return delete_folders(spark, expired_days(spark, path, as_of, days))


# ------------------------------------------------------------- key merging

def key_merge(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``existing`` with the same key;
    other existing rows stay.  Keys compare null-safely."""
    cond = [existing[k].eqNullSafe(new[k]) for k in key]
    kept = existing.join(new.select(*key), cond, "left_anti")
    return kept.unionByName(new.select(*existing.columns))


def replace_partition(existing: DataFrame, new: DataFrame, part_col: str, values) -> DataFrame:
    """Drop the given partition values from ``existing`` and add ``new``."""
    vals = [F.lit(v if isinstance(v, str) else v.isoformat()).cast("date") for v in values]
    return existing.where(~F.col(part_col).isin(vals)).unionByName(new.select(*existing.columns))


def upsert_table(spark: SparkSession, path: str, new: DataFrame, key: list[str], part_col: str,
                 replace: list | None = None) -> DataFrame:
    """Apply ``new`` to the Parquet table at ``path`` (partitioned by
    ``part_col``) and return the table.

    Without ``replace`` (U1/U3) rows of the same key are replaced: only the
    partitions ``new`` touches are read, merged, and written back.  With
    ``replace`` (U2) the given partition values are replaced whole; nothing is
    read.  Either way the rows to come are written aside in the shared folder
    before a file of the table goes, so ``new`` may read the table itself and
    a failure before that leaves it as it was; then the partitions with rows
    are replaced, and only then asked-for values without a row are emptied.
    A re-run of a broken run completes it."""
    old = read_if_there(spark, path)
    new = written(new, "upsert-new")
    if replace is not None:
        wanted = [_iso_text(v) for v in replace]
        merged = new.where(F.col(part_col).cast("string").isin(wanted))
    elif old is not None:
        touched = [r[0] for r in new.select(part_col).distinct().collect()]  # partition values, bounded by days
        kept = old.select(*new.columns).where(F.col(part_col).isin(touched))
        merged = written(key_merge(kept, new, key), "upsert-merged")
    else:
        merged = new
    # hash on (partition, key): a big partition spreads over many tasks,
    # small ones coalesce (AQE sizes the tasks); no range-sampling pass
    (merged.repartition(F.col(part_col), *[F.col(k) for k in key if k != part_col])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path))
    if replace is not None and old is not None:
        filled = {_iso_text(r[0]) for r in merged.select(F.col(part_col).cast("string")).distinct().collect()}  # bounded by ``replace``
        bare = spark.createDataFrame([], old.drop(part_col).schema)
        for v in sorted(set(wanted) - filled):
            bare.write.mode("overwrite").parquet(f"{path}/{part_col}={v}")
    return spark.read.schema(new.schema).parquet(path)


def _iso_text(v) -> str:
    return v if isinstance(v, str) else v.isoformat()


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
