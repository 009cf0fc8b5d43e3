"""Column builders for reward vectors.

A reward vector is one nullable DOUBLE column per reward function. Missing is NULL,
never NaN: NaN poisons ``avg``/``stddev`` and sorts as the greatest value in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _weights(names: Sequence[str], weights: Sequence[float] | None) -> list[float]:
    if weights is None:
        return [1.0] * len(names)
    if len(weights) != len(names):
        raise ValueError(f"{len(weights)} reward weights given for {len(names)} reward functions")
    return [float(w) for w in weights]


def weighted_reward(cols: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Weighted sum that skips missing rewards; a row with every reward missing gives 0."""
    ws = _weights(cols, weights)
    terms = [F.coalesce(F.col(c) * F.lit(w), F.lit(0.0)) for c, w in zip(cols, ws)]
    return reduce(lambda a, b: a + b, terms)


def plain_score(cols: Sequence[str]) -> Column:
    """Unweighted sum used to rank buffered rows; any missing reward makes it NULL."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def all_missing(cols: Sequence[str]) -> Column:
    """True when no reward function produced a value for the row."""
    return F.coalesce(*[F.col(c) for c in cols]).isNull()
