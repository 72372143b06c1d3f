"""The corpus pipeline: five llm operators over ``documents``, each stage
written as Parquet and read again by the next.

All stages but the last return the columns of ``documents``; the last returns
packed token pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate, language, lines, packing, simhash
from marquee.llm.common import prepare, written
from marquee.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a letter and rows of ambiguous language go."""
    prepare(spark)
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later similar lines go out of the texts; documents left empty by that go."""
    prepare(spark)
    return lines.cleaned(docs).where(~F.col("emptied")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays: the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=3, bits=2)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark windows go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the kept documents, packed into sequences."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]

#: SQL expresses neither the classifier nor the packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents``."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
