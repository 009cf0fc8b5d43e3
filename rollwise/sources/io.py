"""Readers and writers for the tables the library produces.

Writers take the destination from the caller; on a cluster that is shared storage. Every
writer is a plain DataFrame write, so a lost executor only re-runs its own tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise import schemas
from rollwise.operators.benchmarks import normalize, union_benchmarks

RAW_TRAINING = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("r1_solution_1", T.StringType()),
        T.StructField("final_answer", T.StringType()),
        T.StructField("split", T.StringType()),
    ]
)


def read_raw_training(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The raw training table with an explicit schema (no inference); ``split`` is NULL where the files have none."""
    return spark.read.schema(RAW_TRAINING).format(fmt).load(path)


def read_rollout_log(spark: SparkSession, path: str, reward_names=("accuracy", "format")) -> DataFrame:
    """The append-only rollout log (S10's output) with its canonical schema, no inference.

    Only committed batches are read: what a failed append left behind is not part of the log.
    """
    schema = schemas.rollouts(reward_names)
    done = committed(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    keyed = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])
    rows = spark.read.schema(keyed).parquet(f"{path.rstrip('/')}/{BATCHES}")
    return rows.filter(F.col("batch_id").isin(done)).drop("batch_id")  # prunes the folders of other batches


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """S3: a prepared table without ``messages`` (the trainer never reads it)."""
    return spark.read.parquet(path).drop("messages")


# The prepared-table folder format, "{prefix}-{n or all}samples[-maxlen{m}]",
# with the training dataset's name as the default prefix.
PREPARED_PREFIX = "DeepMath"


def prepared_folder(sample_size: int | None, max_length: int | None, prefix: str = PREPARED_PREFIX) -> str:
    """S5 folder name: ``{prefix}-{n or all}samples[-maxlen{m}]``."""
    size = f"{sample_size}" if sample_size else "all"
    length = f"-maxlen{max_length}" if max_length else ""
    return f"{prefix}-{size}samples{length}"


def write_prepared(df: DataFrame, root: str, sample_size: int | None, max_length: int | None) -> str:
    """Write the prepared table, split as a partition column."""
    path = root.rstrip("/") + "/" + prepared_folder(sample_size, max_length)
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_benchmark_sources(spark: SparkSession, specs: Iterable[Mapping[str, str]]) -> DataFrame:
    """Read each spec ``{path, alias[, format]}``, normalise it, and union them."""
    parts = []
    for spec in specs:
        df = spark.read.format(spec.get("format", "parquet")).load(spec["path"])
        parts.append(normalize(df, spec["alias"]))
    return union_benchmarks(parts)


def write_benchmarks(combined: DataFrame, path: str) -> None:
    """The combined benchmark, one folder per dataset."""
    combined.write.mode("overwrite").partitionBy("dataset").parquet(path)


def read_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    """Read back the combined table; ``dataset`` stays a column (no per-alias loop)."""
    return spark.read.parquet(path).select("dataset", "problem", "answer")


def write_metric_summary(summary: DataFrame, path: str) -> None:
    """One JSON object per dataset, ``{dataset, metrics: {name: value}}``.

    A dataset has a fixed, small set of metrics (total, pass@k, avg@k for k <= 256), so the
    map is built per dataset group; the folder holds JSON-lines part files.
    """
    per_ds = summary.groupBy("dataset").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))
    per_ds.write.mode("overwrite").json(path)


def read_metric_summary(spark: SparkSession, path: str) -> DataFrame:
    """S7 read back: ``(dataset, metric, value)``."""
    doc = spark.read.schema("dataset string, metrics map<string,double>").json(path)
    return doc.select("dataset", F.explode("metrics").alias("metric", "value"))


def write_inferences(rows: DataFrame, path: str) -> None:
    """Every graded output as JSON lines; UTF-8 text is written as is."""
    rows.write.mode("overwrite").option("encoding", "UTF-8").json(path)


def write_completions(table: DataFrame, path: str) -> None:
    """``step, prompt, completion, <reward columns>``, one folder per step.

    A step is written whole: writing it again (a retried job) replaces its folder and leaves
    the other steps alone.
    """
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("step").parquet(path)


# The names a merged batch has for columns of the log.
BATCH_NAMES = {"step": "batch_step", "block": "batch_block", "slot": "batch_slot"}


# The log's folders: rows by batch, and one marker file per committed batch.
BATCHES, COMMITS = "batches", "commits"


def committed(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches the log holds, one marker per append."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{COMMITS}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []


def _commit(spark: SparkSession, path: str, batch_id: str) -> None:
    """Publish a batch: creating its marker is one atomic step, done after all its files are in place."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{COMMITS}/{batch_id}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def rows_id(rows: DataFrame) -> str:
    """An id of a batch of log rows, the same for the same rows in any order."""
    key = F.xxhash64("rollout_id", "prompt_key", "step", "seq").cast("decimal(38,0)")
    n, total, lo, hi = rows.agg(F.count(F.lit(1)), F.sum(key), F.min("seq"), F.max("seq")).first()
    return f"{lo}_{hi}_{n}_{int(total or 0) & (1 << 64) - 1:016x}"


def append_rollouts(rollouts: DataFrame, path: str, reward_names=("accuracy", "format"), batch_id: str | None = None) -> str:
    """Append online rollouts to the log in its canonical schema (replayed rows are never pushed back).

    Takes log rows or rows of a merged batch. Columns the rows lack are written as NULL, but
    a row cannot do without its id, prompt, step and append number.

    An append can be retried: its rows go to a folder of their own, named by ``batch_id`` (made
    from the rows where none is given), and count only once the batch is committed. A batch that
    is committed already is left as it is; one that failed midway is written anew. Returns the id.
    """
    spark = rollouts.sparkSession
    if "is_online" in rollouts.columns:
        rollouts = rollouts.filter(F.col("is_online") == 1)
    have = {f.name: F.col(f.name) for f in rollouts.schema.fields}
    for name, batch_name in BATCH_NAMES.items():
        if name not in have and batch_name in have:
            have[name] = have[batch_name]
    schema = schemas.rollouts(reward_names)
    missing = [n for n in ("rollout_id", "prompt_key", "step", "seq") if n not in have]
    if missing:
        raise ValueError(f"rollouts lack {missing}")
    columns = [have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    rows = rollouts.select(*columns)
    batch_id = batch_id or rows_id(rows)
    if not re.fullmatch(r"[A-Za-z0-9_-][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r} is no file name")
    if batch_id not in committed(spark, path):
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCHES}/batch_id={batch_id}")
        _commit(spark, path, batch_id)
    return batch_id
