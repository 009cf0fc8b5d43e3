"""Running streaming queries to completion on files (``availableNow``), with checkpoints.

Paths live under the session's shared checkpoint folder; each run takes a fresh folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.session import checkpoint_path


def run_folder(spark: SparkSession, name: str) -> str:
    return checkpoint_path(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def appends_in_order(df: DataFrame, folder: str, order_col: str, n_chunks: int) -> Iterator[str]:
    """Write ``df`` as ``n_chunks`` appends in ``order_col`` order, one folder per chunk, the way a log
    grows: each append is written when it is asked for. Yields the glob to stream from after each.

    The plan behind ``df`` runs once, into one folder; the chunks are copied from there."""
    spark = df.sparkSession
    df.write.parquet(f"{folder}-all")
    staged = spark.read.schema(df.schema).parquet(f"{folder}-all")
    lo, hi = staged.agg(F.min(order_col), F.max(order_col)).first()
    width = max((int(hi) - int(lo) + n_chunks) // n_chunks, 1) if lo is not None else 1
    for k in range(n_chunks):
        a, b = (lo or 0) + k * width, (lo or 0) + (k + 1) * width
        part = staged.filter((F.col(order_col) >= a) & (F.col(order_col) < b))
        part.write.mode("overwrite").parquet(f"{folder}/{k:05d}")
        yield f"{folder}/*/*.parquet"


def stage_in_order(df: DataFrame, folder: str, order_col: str, n_chunks: int) -> str:
    """All appends of :func:`appends_in_order` at once; returns the glob to stream from.

    The files of one append come in no order: a trigger that must not split one reads it alone."""
    return [*appends_in_order(df, folder, order_col, n_chunks)][-1]


def file_stream(spark: SparkSession, glob: str, schema, max_files: int | None = 2) -> DataFrame:
    """``max_files`` new files a trigger (None: all that are there)."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(glob)


def append_to_parquet(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Run an append-mode stream to a parquet sink until the input is drained."""
    q = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    q.trigger(availableNow=True).start(sink).awaitTermination()


def complete_to_parquet(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Run a complete-mode aggregation; every micro-batch overwrites the sink table (idempotent on retry)."""

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("complete")
    q.trigger(availableNow=True).start().awaitTermination()
