"""Training-data pipeline: quality classifier, exact dedup, near dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and gives what the next one reads as its documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import bpe, chosen_path, exact_dedup, mixing, quality_classifier
from ebbtide.llm.queries import VOCABULARY
from ebbtide.session import scratch_path

#: Trained models and seeded draws are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    weights = quality_classifier.fit_classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.good_documents(docs, weights)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near duplicates."""
    return chosen_path.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of sources, languages and topics."""
    return mixing.mixed(docs, mixing.fit_topics(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as ids, with the hash of what they decode to."""
    return bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), keep_ids=True)


STAGES = [
    ("quality classifier", keep_good), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies), ("mixing", mix_sources),
    ("BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
