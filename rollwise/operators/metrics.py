"""Training metrics per step (A1-A8) as a long table ``(mode, step, metric, value)``.

One aggregate with two grouping sets reads the rows: by block side (one block's fresh or replayed
rows) for the group's reward mean and deviation, and by step and side for everything else. It
combines map-side, so a step with any share of the rows leaves a task as a few rows, and no window,
sort or join touches rows or groups. Deviations are Spark's mergeable count, mean and squared
distances, never raw squares, so values far from zero lose no digits. The running token count is
a window over the per-step table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def step_metrics(
    batch: DataFrame,
    rewards: Sequence[str],
    *,
    reward: str = "reward",
    length: str = "completion_len",
    prompt_length: str | None = None,
    terminated: str = "terminated",
) -> DataFrame:
    """Wide per-step metrics. ``batch`` carries ``mode``, ``batch_step``, ``is_online`` and the columns named here.

    ``num_tokens`` (A7) counts prompt and completion tokens of all training rows up to the
    step, whatever the row's mode: an eval step shows the tokens trained on so far. A group of
    one row has deviation 0, as for its advantage (V5).
    """
    groups = ["mode", "batch_step", "prompt_key", "batch_block", "is_online"]
    term, size = F.col(terminated), F.col(length)
    tokens = size + F.col(prompt_length) if prompt_length else size
    first = [
        F.count(F.lit(1)).alias("n"),
        F.avg(reward).alias("gm"),
        F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("gs"),
        F.sum(size).alias("len_sum"),
        F.min(size).alias("len_min"),
        F.max(size).alias("len_max"),
        F.count(F.when(term, 1)).alias("t_n"),
        F.sum(F.when(term, size)).alias("t_sum"),
        F.min(F.when(term, size)).alias("t_min"),
        F.max(F.when(term, size)).alias("t_max"),
        F.sum(F.when(F.col("mode") == "train", tokens).otherwise(0)).alias("tokens"),
    ]
    for i, r in enumerate(rewards):
        x = F.col(r).cast("double")
        first += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    sets = [[F.col(c) for c in groups], [F.col(c) for c in ("mode", "batch_step", "is_online")]]
    g = batch.groupingSets(sets, *groups).agg(F.grouping_id().alias("_set"), *first)

    # The rows of a step and side have _set > 0, those of its groups 0.
    def side(name: str, online: int | None = None) -> Column:
        return F.when((F.col("_set") > 0) & (F.lit(True) if online is None else F.col("is_online") == online), F.col(name))

    def on(name: str, online: int) -> Column:
        return F.when((F.col("_set") == 0) & (F.col("is_online") == online), F.col(name))

    has_off = F.count(side("n", 0)) > 0
    # A4: offline metrics are 0 when the step replayed nothing
    off = lambda c: F.when(has_off, c).otherwise(F.lit(0.0))
    aggs = []
    for i, r in enumerate(rewards):
        aggs += [
            F.max(side(f"m{i}", 1)).alias(f"rewards/{r}/online_mean"),
            F.max(side(f"s{i}", 1)).alias(f"rewards/{r}/online_std"),
            off(F.max(side(f"m{i}", 0))).alias(f"rewards/{r}/offline_mean"),
            off(F.max(side(f"s{i}", 0))).alias(f"rewards/{r}/offline_std"),
            F.min(f"lo{i}").alias(f"rewards/{r}/min"),
            F.max(f"hi{i}").alias(f"rewards/{r}/max"),
        ]
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    aggs += [
        (F.sum(side("len_sum")) / F.sum(side("n"))).alias("completions/mean_length"),
        F.min("len_min").cast("double").alias("completions/min_length"),
        F.max("len_max").cast("double").alias("completions/max_length"),
        (F.lit(1.0) - F.sum(side("t_n")) / F.sum(side("n"))).alias("completions/clipped_ratio"),
        zero(F.try_divide(F.sum(side("t_sum")), F.sum(side("t_n")))).alias("completions/mean_terminated_length"),
        zero(F.min("t_min")).alias("completions/min_terminated_length"),
        zero(F.max("t_max")).alias("completions/max_terminated_length"),
        F.sum(side("tokens")).cast("double").alias("_step_tokens"),
        # A3: mean of group means / stds
        F.avg(on("gm", 1)).alias("reward/online"),
        F.avg(on("gs", 1)).alias("reward/online_std"),
        off(F.avg(on("gm", 0))).alias("reward/offline"),
        off(F.avg(on("gs", 0))).alias("reward/offline_std"),
    ]
    wide = g.groupBy("mode", "batch_step").agg(*aggs)
    # Over the per-step table only (one row per mode and step); rows of one step share the value
    run = Window.orderBy("batch_step").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    wide = wide.withColumn("num_tokens", F.sum("_step_tokens").over(run)).drop("_step_tokens")
    return wide.withColumnRenamed("batch_step", "step")


def to_long(wide: DataFrame) -> DataFrame:
    names = [c for c in wide.columns if c not in ("mode", "step")]
    cast = wide.select("mode", "step", *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    return cast.unpivot(["mode", "step"], names, "metric", "value")


def logging_window(long: DataFrame, every: int = 5) -> DataFrame:
    """Average each metric over windows of ``every`` steps; ``num_tokens`` keeps its last value.

    Metrics of the eval mode carry the ``eval_`` prefix.
    """
    win = F.floor(F.col("step") / F.lit(every)).cast("bigint")
    g = long.groupBy("mode", win.alias("window"), "metric").agg(
        F.avg("value").alias("_avg"), F.max_by("value", "step").alias("_last")
    )
    value = F.when(F.col("metric") == "num_tokens", F.col("_last")).otherwise(F.col("_avg"))
    name = F.when(F.col("mode") == "eval", F.concat(F.lit("eval_"), F.col("metric"))).otherwise(F.col("metric"))
    return g.select("mode", "window", name.alias("metric"), value.alias("value"))
