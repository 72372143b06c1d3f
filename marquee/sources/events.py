"""Event ingest: stream source, typing projection, JSON ingest with defaults,
keyed publish frames, and structured request-log ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Producer-side event record (epoch-ms timestamp), the wire contract.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("movie_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("progress_seconds", T.IntegerType()),
])

STORED_COLUMNS = ["event_id", "user_id", "movie_id", "event_type", "event_time", "event_date",
                  "device_type", "session_id", "progress_seconds"]

REQUEST_LOG_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])


def stream_events(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The event stream.  Kafka and the Avro connector are not on this
    classpath, so the source is a file stream with the wire schema; on a
    cluster with the connectors use ``kafka_events``."""
    r = spark.readStream.format(fmt).schema(RAW_EVENT_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_events(spark: SparkSession, brokers: str, topic: str, avro_schema_json: str) -> DataFrame:
    """S1 over Kafka: registry-framed Avro (5-byte prefix) decoded to columns."""
    from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    payload = F.expr("substring(value, 6, length(value) - 5)")
    return raw.select(from_avro(payload, avro_schema_json).alias("e")).select("e.*")


def type_events(raw: DataFrame) -> DataFrame:
    """Typing projection raw -> store (id text lower-cased, ms -> UTC timestamp)."""
    return raw.select(
        F.lower(F.col("event_id")).alias("event_id"),
        "user_id", "movie_id", "event_type",
        F.timestamp_millis(F.col("timestamp")).alias("event_time"),
        "device_type", "session_id",
        F.col("progress_seconds").cast("int").alias("progress_seconds"),
    )


def with_store_columns(typed: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Derived columns of the raw store: event_date and ingested_at."""
    return (typed.withColumn("event_date", F.to_date("event_time"))
            .withColumn("ingested_at", ingested_at if ingested_at is not None else F.current_timestamp()))


def ingest_json(lines: DataFrame, now_ms: Column | None = None, col: str = "value") -> DataFrame:
    """JSON event bodies -> wire rows.  A missing event_id is generated;
    a missing *or zero* timestamp becomes ``now``."""
    now_ms = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())
    e = F.from_json(F.col(col), RAW_EVENT_SCHEMA).alias("e")
    parsed = lines.select(e).select("e.*")
    ts = F.col("timestamp")
    return parsed.select(
        F.coalesce(F.col("event_id"), F.expr("uuid()")).alias("event_id"),
        "user_id", "movie_id", "event_type",
        F.when(ts.isNull() | (ts == 0), now_ms).otherwise(ts).alias("timestamp"),
        "device_type", "session_id", "progress_seconds",
    )


def publish_frames(events: DataFrame) -> DataFrame:
    """Keyed publish records: key = user_id (per-user order), JSON value,
    headers carrying event_type and event_id.  Avro framing needs spark-avro;
    ``to_avro`` replaces ``to_json`` where it is present."""
    headers = F.array(
        F.struct(F.lit("event_type").alias("key"), F.encode(F.col("event_type"), "UTF-8").alias("value")),
        F.struct(F.lit("event_id").alias("key"), F.encode(F.col("event_id"), "UTF-8").alias("value")),
    )
    return events.select(
        F.encode(F.col("user_id"), "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*[F.col(c) for c in events.columns])), "UTF-8").alias("value"),
        headers.alias("headers"),
    )


def parse_request_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON log lines -> typed rows; a top-level ``password`` in the body
    is masked, a body that is not a JSON object is dropped."""
    rec = F.from_json(F.col(col), REQUEST_LOG_SCHEMA)
    body_json = F.get_json_object(F.col(col), "$.body")
    body = F.from_json(body_json, T.MapType(T.StringType(), T.StringType()))
    masked = F.transform_values(body, lambda k, v: F.when(k == "password", F.lit("***")).otherwise(v))
    return lines.select(rec.alias("r"), masked.alias("body_masked")).select(
        "r.request_id", "r.method", "r.endpoint", "r.status_code", "r.duration_ms",
        F.to_timestamp("r.timestamp").alias("ts"), "body_masked")


def request_stats(log: DataFrame) -> DataFrame:
    """Per endpoint and status: count and latency percentiles."""
    return log.groupBy("endpoint", "status_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("duration_ms", 0.5).alias("p50"),
        F.percentile_approx("duration_ms", 0.99).alias("p99"))


def observe_published(frames: DataFrame, name: str = "published"):
    """Count the records a publish job sends, as an observed metric of
    the same job (no second pass).  Returns (frame, observation); read
    ``observation.get["published"]`` after the write."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return frames.observe(obs, F.count(F.lit(1)).alias("published")), obs


def publish_counted(events: DataFrame, path: str, event_types: list[str]) -> dict[str, int]:
    """A13 by event type: write the publish frames to ``path`` and return how
    many of each type that job sent, observed in the job itself; events of no
    listed type count under ``other``."""
    from pyspark.sql import Observation
    obs = Observation("published by type")
    kind = F.coalesce(F.when(F.col("event_type").isin(event_types), F.col("event_type")), F.lit("other"))
    counted = events.observe(obs, *[F.count_if(kind == t).alias(t) for t in [*event_types, "other"]])
    publish_frames(counted).write.mode("overwrite").parquet(path)
    return obs.get
