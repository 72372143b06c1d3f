"""Daily export: read the three metric tables for a date, union them into
one tagged wide table, and write it idempotently per date and format."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import delete_folders, list_folders, put_in_place

EXPORT_COLUMNS = ["table", "metric_date", "metric_name", "metric_value", "dimensions", "computed_at",
                  "movie_id", "rank", "views", "cohort_date", "day_offset", "cohort_size", "returned",
                  "retention_pct"]
FORMATS = ("csv", "json", "parquet")


def _d(day):
    return F.lit(day if isinstance(day, str) else day.isoformat()).cast("date")


def tables_for_date(metrics: DataFrame, top: DataFrame, retention: DataFrame, day):
    """S7 scans: each table filtered on its date column (partition pruning
    when the tables are the day-partitioned Parquet tables)."""
    return (metrics.where(F.col("metric_date") == _d(day)),
            top.where(F.col("metric_date") == _d(day)),
            retention.where(F.col("cohort_date") == _d(day)))


def metrics_for_date(metrics: DataFrame, top: DataFrame, retention: DataFrame, day) -> DataFrame:
    """S7 in one long frame: section, name, value, rank_or_offset."""
    m, t, r = tables_for_date(metrics, top, retention, day)
    return (m.select(F.lit("metrics").alias("section"), F.col("metric_name").alias("name"),
                     F.col("metric_value").alias("value"), F.lit(None).cast("int").alias("rank_or_offset"))
            .unionByName(t.select(F.lit("top_movies").alias("section"), F.col("movie_id").alias("name"),
                                  F.col("views").cast("double").alias("value"),
                                  F.col("rank").cast("int").alias("rank_or_offset")))
            .unionByName(r.select(F.lit("retention").alias("section"),
                                  F.date_format("cohort_date", "yyyy-MM-dd").alias("name"),
                                  F.col("retention_pct").alias("value"),
                                  F.col("day_offset").cast("int").alias("rank_or_offset"))))


def export_union(metrics: DataFrame, top: DataFrame, retention: DataFrame, day) -> DataFrame:
    """The 14-column wide layout with a ``table`` tag per source."""
    m, t, r = tables_for_date(metrics, top, retention, day)
    parts = [
        m.select(F.lit("metrics").alias("table"), "metric_date", "metric_name", "metric_value",
                 "dimensions", "computed_at"),
        t.select(F.lit("top_movies").alias("table"), "metric_date", "computed_at", "movie_id",
                 F.col("rank").cast("int").alias("rank"), F.col("views").cast("long").alias("views")),
        r.select(F.lit("retention").alias("table"), "computed_at", "cohort_date",
                 F.col("day_offset").cast("int").alias("day_offset"),
                 F.col("cohort_size").cast("int").alias("cohort_size"),
                 F.col("returned").cast("int").alias("returned"), "retention_pct"),
    ]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return out.select(*EXPORT_COLUMNS)


def export_document(metrics: DataFrame, top: DataFrame, retention: DataFrame, day) -> DataFrame:
    """The JSON export as one nested row: a list per section (metrics by name,
    movies by rank, retention by day offset) and the latest ``computed_at``.
    The sections hold one day of aggregates (tens of rows), so collecting
    them per document is bounded."""
    m, t, r = tables_for_date(metrics, top, retention, day)
    lead = lambda df, col: [col, *[c for c in df.columns if c != col]]
    m, t, r = m.select(lead(m, "metric_name")), t.select(lead(t, "rank")), r.select(lead(r, "day_offset"))
    tagged = (m.select(F.struct(*m.columns).alias("metrics"))
              .unionByName(t.select(F.struct(*t.columns).alias("top_movies")), allowMissingColumns=True)
              .unionByName(r.select(F.struct(*r.columns).alias("retention")), allowMissingColumns=True))
    return tagged.agg(
        F.lit(day if isinstance(day, str) else day.isoformat()).alias("export_date"),
        F.max(F.coalesce(*[F.col(f"{c}.computed_at") for c in ("metrics", "top_movies", "retention")])).alias("computed_at"),
        F.sort_array(F.collect_list("metrics")).alias("metrics"),
        F.sort_array(F.collect_list("top_movies")).alias("top_movies"),
        F.sort_array(F.collect_list("retention")).alias("retention"))


def export_path(root: str, day, fmt: str) -> str:
    """Deterministic location per date and format."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    d = day if isinstance(day, str) else day.isoformat()
    return f"{root.rstrip('/')}/daily/{d}/aggregates.{fmt}"


def write_export(metrics: DataFrame, top: DataFrame, retention: DataFrame, day, fmt: str, root: str) -> str:
    """The export of (day, fmt) as one file at its path.  A task writes it
    aside (a day's aggregates are small; no rows still make a file), then one
    rename puts it in place of the file of an earlier run, so a reader sees
    either the old file or the new one."""
    path = export_path(root, day, fmt)
    aside = f"{path.rsplit('/', 1)[0]}/_aside-{uuid.uuid4().hex[:12]}"
    rows = (export_document if fmt == "json" else export_union)(metrics, top, retention, day)
    writer = rows.repartition(1).write
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(aside)
    spark = rows.sparkSession
    part, = list_folders(spark, aside, "part-")
    put_in_place(spark, part, path)
    delete_folders(spark, [aside])
    return path
