"""The corpus pipeline: quality rules, near-dedup, secret redaction, mixing, sampled encoding.

Every stage is written as Parquet under the session's shared checkpoint folder and read again
as the next one's documents. All but the last return the columns of ``documents``: the first
drops rejected documents, the second keeps one document of each near-duplicate group, the
third replaces secrets in the texts, the fourth puts the documents in mixed order, the last
gives each document its sampled segmentations. Empty input gives empty output at every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.llm import mixing, pieces, quality, secrets, simhash
from rollwise.llm.common import read
from rollwise.session import checkpoint_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the fences of their language and source."""
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of fingerprints at most three bits apart."""
    return simhash.deduplicate(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced, and the length of the text as it is then."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes their sources to the target weights."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the sampled segmentations (piece ids, log probability, log inclusion) of each text."""
    return pieces.encode(docs).select("doc_id", "samples")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("encoding", encoding),
]

#: XXH64 fingerprints, the Pfair order and sampled segmentations are beyond SQL; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = checkpoint_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
