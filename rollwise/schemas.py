"""Canonical table schemas and a check applied when tables are read.

Schemas are explicit StructTypes: readers pass them to ``spark.read.schema`` (no inference)
and :func:`check` verifies that a DataFrame carries the required columns with the right types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

PROMPTS = T.StructType(
    [
        T.StructField("prompt_key", T.StringType()),
        T.StructField("prompt", MESSAGES),
        T.StructField("solution", T.StringType()),
        T.StructField("ground_truth", T.StringType()),
        T.StructField("split", T.StringType()),
    ]
)


def rollouts(reward_names: Sequence[str] = ("accuracy", "format")) -> T.StructType:
    """The append-only rollout log; one nullable DOUBLE ``r_<name>`` per reward function."""
    return T.StructType(
        [
            T.StructField("rollout_id", T.LongType()),
            T.StructField("prompt_key", T.StringType()),
            T.StructField("mode", T.StringType()),
            T.StructField("step", T.LongType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("visit", T.LongType()),
            T.StructField("slot", T.IntegerType()),
            T.StructField("seq", T.LongType()),
            T.StructField("completion", T.StringType()),
            T.StructField("completion_ids", T.ArrayType(T.IntegerType())),
            T.StructField("old_logps", T.ArrayType(T.DoubleType())),
            T.StructField("ref_logps", T.ArrayType(T.DoubleType())),
            *[T.StructField(f"r_{n}", T.DoubleType()) for n in reward_names],
        ]
    )


EVAL = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("problem_id", T.StringType()),
        T.StructField("problem", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("prompt_type", T.StringType()),
        T.StructField("sample_idx", T.IntegerType()),
        T.StructField("output", T.StringType()),
        T.StructField("flag", T.DoubleType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("mode", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def check(df: DataFrame, schema: T.StructType, *, required: Sequence[str] | None = None) -> DataFrame:
    """Raise when a required column is missing or has another type; returns ``df`` unchanged."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    names = list(required) if required is not None else list(want)
    problems = []
    for n in names:
        if n not in have:
            problems.append(f"missing column {n!r}")
        elif have[n] != want[n]:
            problems.append(f"column {n!r} is {have[n].simpleString()}, expected {want[n].simpleString()}")
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df
