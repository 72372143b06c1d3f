"""The outbox as a change feed.

The outbox table is read as a file stream, so a run takes the files that came
since the last one; the offsets are in the stream's checkpoint.  Messages are
written by micro-batch number and a batch that is run again after a break
replaces what it wrote, so each outbox row is published once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import notify as nt
from ..operators.store import read_if_there


def _write_batch(batch: DataFrame, batch_id: int, sink: str) -> None:
    (nt.outbox_messages(batch).withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))


def publish_outbox(spark: SparkSession, outbox_path: str, sink: str, checkpoint: str, max_files: int = 64) -> None:
    """Publish what the outbox table at ``outbox_path`` holds beyond the last
    run; the table only grows by files."""
    schema = spark.read.parquet(outbox_path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(outbox_path)
    query = (rows.writeStream.foreachBatch(lambda batch, batch_id: _write_batch(batch, batch_id, sink))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def published(spark: SparkSession, sink: str) -> DataFrame | None:
    """The messages at ``sink``; None if there is none yet."""
    messages = read_if_there(spark, sink)
    return None if messages is None else messages.drop("batch_id")
