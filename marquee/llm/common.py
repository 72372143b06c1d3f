"""Session settings and written intermediate tables of the llm operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import ensure_checkpoint_dir, scratch_path, ship_package


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that bound the memory of Python tasks: Arrow batches of at
    most a few MB, so a run of very long documents is never one batch."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def give_back() -> None:
    """Returns to the system what this process has freed but its allocators keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's alone
    if trim:
        trim(0)


def lean(function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function`` for ``mapInArrow``, whose worker gives its free memory back
    after every task: workers are used again, and what each kind of task leaves
    behind would add up over the stages of a long job."""
    @wraps(function, assigned=())
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()
    return run


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, read back.

    Cuts the lineage and freezes values (row numbers, Python results) against
    recomputation after a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def document_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list:
    """(id, text hash): equal for repeated rows of one document and for
    nothing else; computed anew wherever it is needed, so no row number has
    to survive between two scans."""
    return [F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key")]


def carried(docs: DataFrame) -> DataFrame:
    """(row, id, text_hash): whole rows as one struct beside what names a
    document, so that no column of theirs can clash; ``select("row.*")`` gives
    them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))


def same_document(right: DataFrame, id_col: str = "doc_id", key_col: str = "text_key"):
    """(``right`` with its names out of the way, condition that joins it to carried rows)."""
    renamed = right.withColumnsRenamed({id_col: "_right_id", key_col: "_right_hash"})
    return renamed, F.col("id").eqNullSafe(F.col("_right_id")) & (F.col("text_hash") == F.col("_right_hash"))
