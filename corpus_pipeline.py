"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import decontaminate, mixing, pii, simhash, toxicity
from skuflow.llm.common import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel model rejects go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the text with the smallest id, then hash, stays; rows without an id stay."""
    gone = simhash.groups(docs).where("doc_id <> component_id or text_hash <> component_hash").where("doc_id is not null").select(
        F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(stage(gone, "near-copies"), (F.col("doc_id") == F.col("_gone"))
                     & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash")), "left_anti")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the texts."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their number of copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("pii", sanitise_personal_data),
    ("mixing", mix_sources),
]

#: No SQL: it cannot express the trained model, components or the Newton solution.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
