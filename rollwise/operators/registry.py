"""Reward functions by name.

Names are validated up front, so a bad configuration fails before any job runs. Replay
strategies, loss flavours and advantage modes (D3-D5) are checked where they are configured:
``ReplayConfig.validate``, ``LossConfig.validate`` and ``advantage.group_keys``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.functions.grading import format_reward, with_accuracy

# A reward builder adds one column ``out`` from the completion and gold columns.
RewardBuilder = Callable[[DataFrame, str, str, str], DataFrame]

REWARDS: dict[str, RewardBuilder] = {
    "format": lambda df, completion, gold, out: df.withColumn(out, format_reward(completion)),
    "accuracy": lambda df, completion, gold, out: with_accuracy(df, completion, gold, out),
}


def parse_reward_names(spec: str | Sequence[str], registry: dict[str, RewardBuilder] | None = None) -> list[str]:
    """A list of names, or one string with names joined by ``_`` or ``,``; every name must exist."""
    reg = REWARDS if registry is None else registry
    names = [n for n in (spec.replace(",", "_").split("_") if isinstance(spec, str) else spec) if n]
    unknown = [n for n in names if n not in reg]
    if unknown or not names:
        raise ValueError(f"unknown reward function(s) {unknown or spec!r}; known: {sorted(reg)}")
    return names


def add_rewards(
    df: DataFrame,
    names: str | Sequence[str],
    *,
    completion: str = "completion",
    gold: str = "solution",
    registry: dict[str, RewardBuilder] | None = None,
) -> DataFrame:
    """One nullable DOUBLE column ``r_<name>`` per reward function."""
    reg = REWARDS if registry is None else registry
    out = df
    for n in parse_reward_names(names, reg):
        out = reg[n](out, completion, gold, f"r_{n}")
    return out


def pandas_reward(fn: Callable[..., pd.Series]) -> Callable[..., Column]:
    """D1 escape hatch: a vectorised reward over declared columns (Arrow batches, not rows).

    ``fn`` takes one pandas Series per column and returns floats; None/NaN become NULL.
    """

    @F.pandas_udf(T.DoubleType())
    def _udf(*cols: pd.Series) -> pd.Series:
        out = pd.Series(fn(*cols), dtype="float64")
        return out.where(out.notna(), None)

    return _udf
