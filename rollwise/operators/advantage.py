"""Group-relative advantages (V1-V3, V5).

A group is one block of one step, ``(prompt, batch_step, batch_block)``; ``split`` adds
``is_online`` so fresh and replayed rows are normalised apart. Groups hold G + k rows at
most, so the window partitions are bounded whatever the key distribution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MODES = ("none", "mixed", "split")


def group_keys(mode: str, key: str = "prompt_key") -> list[str]:
    if mode not in MODES:
        raise ValueError(f"advantage mode must be one of {MODES}, got {mode!r}")
    keys = [key, "batch_step", "batch_block"]
    return keys + ["is_online"] if mode == "split" else keys


def advantages(
    batch: DataFrame,
    mode: str = "split",
    *,
    reward: str = "reward",
    key: str = "prompt_key",
    scale_rewards: bool = True,
    eps: float = 1e-4,
) -> DataFrame:
    """Add ``grp_mean``, ``grp_std`` and ``advantage``.

    ``none`` and ``mixed`` normalise over the whole block; ``split`` over fresh and replayed
    rows separately. The std is the sample std; a group of one row has none (V5), taken
    as 0 so its advantage is 0.
    """
    w = Window.partitionBy(*group_keys(mode, key))
    mean = F.avg(reward).over(w)
    std = F.coalesce(F.stddev_samp(reward).over(w), F.lit(0.0))
    out = batch.withColumn("grp_mean", mean).withColumn("grp_std", std)
    adv = F.col(reward) - F.col("grp_mean")
    if scale_rewards:
        adv = adv / (F.col("grp_std") + F.lit(eps))
    return out.withColumn("advantage", adv)
