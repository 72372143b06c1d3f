"""The registered queries of the llm operators: whole tables, contract columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import ann, chat, decontaminate, language, lines, negatives, packing, quality, repair, secrets, sharding, simhash, toxicity
from marquee.llm.common import prepare
from marquee.sources.tables import read_table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.grade_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.identify(read_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_key")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, bits=2)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("removed_lines").alias("n_removed"), F.array_join("removed_lines", ",").alias("removed_lines"), "text")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), 16)


#: The contract's extra conversation: both turns say control strings.
_MARKS = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_MARKS).alias("text"))
    back = chat.read_back(chat.format_paths(chat.chain_nodes(rows.unionByName(extra))))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    loss = F.array_join("loss_texts", "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), digest(said).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), digest(loss).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = negatives.usable(read_table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: rows dropped, emptied, stripped of ``.!?``, repeated or given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    copies = F.when(fate == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"),
                       fate.alias("fate"), F.explode(F.array_repeat(F.lit(0), copies))).where("fate <> 0").drop("fate", "col")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.repair(damaged(rows))
    none = {c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    ids = rows.select("conv_id").distinct()
    report = repair.report(found).withColumnRenamed("conv_id", "_known")
    digest = repair.digests(found).withColumnRenamed("conv_id", "_said")
    return (ids.join(report, ids["conv_id"].eqNullSafe(report["_known"]), "left").join(digest, ids["conv_id"].eqNullSafe(digest["_said"]), "left")
            .select("conv_id", *none.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_neighbours, op3_packing, op4_language, op5_secrets, op6_decontamination, op7_simhash, op8_line_dedup, op9_sharding, op10_chat,
                                   op11_negatives, op12_quality, op13_repair)}
