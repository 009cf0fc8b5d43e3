"""Readers for the input tables.

Each reader returns a lazy DataFrame; callers select the columns they need so the
parquet scan reads only those (Catalyst's column pruning reaches ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
