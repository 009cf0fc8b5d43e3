"""Sampling schedules as tables.

The trainer's sampler yields indices one by one from a permutation held in memory. Here
the permutation is a seeded md5 order, every row gets its global position without a
single-task window (bucketed offsets), and repetitions are generated per row with
``sequence`` — the output is the schedule table, ``(sched_pos, chunk, repeat, idx, mini, key)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwise.operators.positions import first_by, global_positions, rank_within_key
from rollwise.operators.prep import seeded_order_key


def positions(df: DataFrame, key: str, *, shuffle: bool = True, seed: int = 42) -> DataFrame:
    """0-based position of every row in the (seeded-shuffled or key) order.

    The unshuffled order ranks by the key's value in ranges of equal counts; the key may have any orderable type.
    """
    if shuffle:
        return global_positions(df.withColumn("_o", seeded_order_key(key, seed)), "_o", key, out="pos").drop("_o")
    return rank_within_key(df, [], key, out="pos")


def repeat_schedule(
    df: DataFrame,
    key: str,
    *,
    batch_size: int,
    repeat_count: int = 1,
    mini_repeat_count: int = 1,
    shuffle: bool = True,
    seed: int = 42,
) -> DataFrame:
    """Cut the order into chunks of ``batch_size``, drop the short tail, repeat each chunk
    ``repeat_count`` times and each index ``mini_repeat_count`` times."""
    if batch_size < 1 or repeat_count < 1 or mini_repeat_count < 1:
        raise ValueError("batch_size, repeat_count and mini_repeat_count must be >= 1")
    n = df.select(F.count(F.lit(1))).scalar()  # scalar subquery: the row count, evaluated once
    b = F.lit(batch_size)
    pos = positions(df.select(key), key, shuffle=shuffle, seed=seed)
    whole = pos.filter(F.col("pos") < F.floor(n / b) * b)
    per = batch_size * repeat_count * mini_repeat_count
    out = (
        whole.withColumn("chunk", F.floor(F.col("pos") / b).cast("bigint"))
        .withColumn("idx", (F.col("pos") % b).cast("bigint"))
        .withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(repeat_count - 1).cast("bigint"))))
        .withColumn("mini", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(mini_repeat_count - 1).cast("bigint"))))
    )
    sched = (
        F.col("chunk") * per
        + F.col("repeat") * (batch_size * mini_repeat_count)
        + F.col("idx") * mini_repeat_count
        + F.col("mini")
    )
    return out.select(sched.cast("bigint").alias("sched_pos"), "chunk", "repeat", "idx", "mini", key)


def eval_schedule(df: DataFrame, key: str, generations: int, *, seed: int = 42) -> DataFrame:
    """T4: every index ``generations`` times, batch 1, one pass, shuffled."""
    return repeat_schedule(df, key, batch_size=1, repeat_count=1, mini_repeat_count=generations, shuffle=True, seed=seed)


def equal_slices(df: DataFrame, batch: str, pos: str, n_slices: int) -> DataFrame:
    """T5: split each batch in ``n_slices`` equal slices in order; the remainder is dropped.

    The batch size comes from a count over the batch (a bounded group).
    """
    size = F.count(F.lit(1)).over(Window.partitionBy(batch))
    per = F.floor(size / F.lit(n_slices))
    out = df.withColumn("_per", per).filter(F.col("_per") > 0)
    out = out.withColumn("slice", F.floor(F.col(pos) / F.col("_per")).cast("bigint"))
    return out.filter(F.col("slice") < n_slices).drop("_per")


def block_heads(rollouts: DataFrame, slot: str = "slot") -> DataFrame:
    """One row per prompt block (every G-th row of a batch)."""
    return rollouts.filter(F.col(slot) == 0)


def last_n(log: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The newest ``n`` rows of a log."""
    return first_by(log, seq, n, newest=True)
