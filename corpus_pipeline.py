"""The training-data pipeline: five stages over ``documents``, each on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the result is
written as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lendlayer.llm.frames import keep, table
from lendlayer.llm.op2_mixing import sample_mixture
from lendlayer.llm.op5_packing import pack_documents
from lendlayer.llm.op7_toxicity import drop_toxic
from lendlayer.llm.op9_exact_dedup import drop_copies
from lendlayer.llm.op10_minhash import drop_near_duplicates


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The first stage's classifier is fitted, which SQL can't express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
