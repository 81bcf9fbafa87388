"""A training-data pipeline over ``documents``: toxicity, quality rules, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next stage's docs, so that a lost executor costs no finished stage. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visfold.llm.common import id_crc32, read
from visfold.llm.compression_bands import keep_quality
from visfold.llm.cost_packing import pack_documents
from visfold.llm.pigeonring_simhash import one_per_group
from visfold.llm.queries import byte_vocabulary
from visfold.llm.string_kernel_svm import drop_toxic, train_toxicity
from visfold.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents predicted toxic by a machine trained on the labels (without every third)."""
    model = train_toxicity(docs, read(spark, sf_dir, "labels").filter(id_crc32() % 3 != 1))
    return drop_toxic(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rules or lie outside the compression bands."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates."""
    return one_per_group(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack_documents(docs, **byte_vocabulary())


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup), ("packing", packing)]

#: Kernels, compression ratios, XXH64 fingerprints and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
