"""Documents to packed sequences: quality rules, near duplicates, benchmark passages, secrets, packing.

Every stage works on all that the one before it kept, written as a table. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waybill.llm import decontamination, minhash, packing, quality_rules, secrets
from waybill.storage import as_table, new_folder

#: Rules are learned from labels, links come of whole sets, ids of a tokenizer: no SQL for them. Tests compare the stages with plain versions.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor a learned one rejects."""
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judge(docs, rules).where("kept").select(*docs.columns)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id."""
    return minhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark passages."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence and its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("near_duplicates", keep_representatives),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir), new_folder(spark, name))
    return docs
