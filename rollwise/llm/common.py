"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.session import checkpoint_path

# Fixed value: a word is a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read again after a loss. The name
    gets a unique suffix, so a retried job never reads an older run's table.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same(pairs: list[tuple[Column, Column]]) -> Column:
    """Null-safe equality of every pair, as one join condition."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & a.eqNullSafe(b)
    return cond


def maybe_broadcast(staged: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only for a staged table whose counted rows stay within ``max_rows``.

    Beyond the bound the table is left to a shuffled join (split by adaptive execution when
    a key is hot); results are the same either way.
    """
    few = staged.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(staged) if few else staged


def row_key(doc_id: Column, th: Column) -> list[Column]:
    """Non-null columns _id, _null, _th naming a row by doc_id and text hash.

    Plain equality on them is null-safe, so a join, a grouping and a window share one shuffle.
    """
    return [F.coalesce(doc_id.cast("long"), F.lit(0)).alias("_id"), doc_id.isNull().alias("_null"), th.alias("_th")]


def packed(df: DataFrame, *needed: Column) -> DataFrame:
    """Every input column inside one struct ``_row``, beside the columns an operator works on.

    Keeps extra input columns from clashing with an operator's own names; ``unpacked`` puts
    them back.
    """
    return df.select(F.struct("*").alias("_row"), *needed)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def text_key(text: str = "text") -> Column:
    """64-bit hash of a text, null like empty; used beside doc_id, never alone."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))
