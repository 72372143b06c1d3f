"""Operator 9: contiguous shards of near-equal bytes from global prefix sums.

Documents are ordered by id, dealt into ranges, and every range knows its
bytes and rows; the running sum over the ranges' totals (one row per range)
turns local running sums into global ones, and the global line of bytes is
cut at equal targets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import shuffle_parts, text_or_empty, written


def _running(batches):
    """Adds the range number and the bytes and rows before each row in its range."""
    part, bytes_before, rows_before = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column("size").to_numpy()
        before = bytes_before + np.cumsum(size) - size
        n = len(size)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("size"), b.column("text_crc32"), pa.array(np.full(n, part, np.int32)),
             pa.array(before.astype(np.int64)), pa.array(np.arange(rows_before, rows_before + n, dtype=np.int64))],
            names=["doc_id", "size", "text_crc32", "part", "bytes_before", "rows_before"])
        bytes_before += int(size.sum())
        rows_before += n


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ``bytes``, shard,
    slot, grown_shard (null: the law has none) and bytes_before (the global
    prefix sum).

    Size is the text's UTF-8 bytes plus 1.  A document goes where its middle
    byte lies between the equal cuts, so a shard misses the target by at most
    one document.  Shards are contiguous in (doc_id, text crc): null ids come
    first, repeated ids and rows stand next to each other, null and empty
    texts have size 1, an empty table gives no rows.  Columns other than id
    and text are not read.  Equal texts may part: the law is ``bytes``.

    A hot id cannot fill one range: crc and a row salt are part of the order.
    Only per-range totals (one row per range) and per-shard first rows (one
    row per shard) pass through the driver.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text_or_empty(text_col)) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text_or_empty(text_col)).alias("text_crc32"),
                       F.pmod(F.monotonically_increasing_id(), F.lit(4096)).alias("salt"))
    order = ["doc_id", "text_crc32", "salt"]
    ranged = slim.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, size long, text_crc32 long, part int, bytes_before long, rows_before long"
    local = written(ranged.mapInArrow(_running, schema), "shard-ranges")

    totals = sorted(tuple(r) for r in local.groupBy("part").agg(F.sum("size"), F.count("*")).collect())
    rows, before, n_before = [], 0, 0
    for part, size, n in totals:
        rows.append((part, before, n_before))
        before, n_before = before + size, n_before + n
    total = max(1, before)
    offsets = F.broadcast(spark.createDataFrame(rows, "part int, part_bytes long, part_rows long"))
    start = F.col("bytes_before") + F.col("part_bytes")
    placed = local.join(offsets, "part").select(
        "doc_id", "size", "text_crc32", start.alias("bytes_before"), (F.col("rows_before") + F.col("part_rows")).alias("row"),
        F.least(F.lit(shards - 1), F.expr(f"(2 * (bytes_before + part_bytes) + size) * {shards}L div {2 * total}L")).cast("int").alias("shard"))
    firsts = [tuple(r) for r in placed.groupBy("shard").agg(F.min("row")).collect()]
    firsts = F.broadcast(spark.createDataFrame(firsts, "shard int, first_row long"))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "bytes_before")
