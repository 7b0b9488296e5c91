"""A cleaning pipeline over `documents`: each stage reads what the stage before it has kept.

Every stage takes (spark, docs, sf_dir) and works on all rows of `docs`; all but the last return the
columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import decontam, jaccard, pieces, pii, rules
from wayfare.llm.graph import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.filter_documents(docs, rules.order_rules(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id."""
    return jaccard.one_of_each(spark, docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.remove_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars counts the new text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number and digest of its piece ids, and the digest of the decoded text."""
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), spans=True)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", benchmark_leaks), ("personal data", personal_data),
          ("piece encoding", piece_ids)]
ORACLE_SQL = None  # the learnt stages have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared scratch folder for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
