"""Token-array operators (F3-F8) as native array expressions, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def left_truncate(ids: Column | str, max_len: int) -> Column:
    """keep the last ``max_len`` tokens (a bare negative ``slice`` would give [] for short arrays)."""
    a = _c(ids)
    return F.slice(a, F.greatest(F.size(a) - F.lit(max_len), F.lit(0)) + F.lit(1), F.lit(max_len))


def eos_mask_length(ids: Column | str, eos: int) -> Column:
    """number of leading positions the completion mask keeps: up to and including the first EOS, all when none."""
    a = _c(ids)
    p = F.array_position(a, F.lit(eos))
    return F.when(p == 0, F.size(a)).otherwise(p).cast("int")


def terminated(ids: Column | str, eos: int) -> Column:
    """the completion holds an EOS."""
    return F.array_contains(_c(ids), F.lit(eos))


def masked_length(ids: Column | str, eos: int, *, mask_truncated: bool) -> Column:
    """F4 + F6: mask length, 0 for rows without EOS when truncated completions are masked."""
    n = eos_mask_length(ids, eos)
    if not mask_truncated:
        return n
    return F.when(terminated(ids, eos), n).otherwise(F.lit(0))


def concat_tokens(prompt_ids: Column | str, completion_ids: Column | str) -> Column:
    """prompt ‖ completion on the token axis."""
    return F.concat(_c(prompt_ids), _c(completion_ids))


def pad_right(a: Column, length: Column, pad) -> Column:
    return F.concat(a, F.array_repeat(F.lit(pad), F.greatest(length - F.size(a), F.lit(0))))


def pad_left(a: Column, length: Column, pad) -> Column:
    return F.concat(F.array_repeat(F.lit(pad), F.greatest(length - F.size(a), F.lit(0))), a)


def rectangular_export(
    df: DataFrame, batch: str, *, prompt: str, completion: str, logps: str | None = None, pad_id: int = -1
) -> DataFrame:
    """F8: pad to the batch maximum, prompts on the left, completions (and log-probs, with 0) on the right.

    Only for export to a dense consumer; the batch maximum is a window over one batch.
    """
    w = Window.partitionBy(batch)
    out = df.withColumn("_lp", F.max(F.size(prompt)).over(w)).withColumn("_lc", F.max(F.size(completion)).over(w))
    out = out.withColumn(f"{prompt}_padded", pad_left(F.col(prompt), F.col("_lp"), pad_id))
    out = out.withColumn(f"{completion}_padded", pad_right(F.col(completion), F.col("_lc"), pad_id))
    if logps:
        out = out.withColumn(f"{logps}_padded", pad_right(F.col(logps), F.col("_lc"), 0.0))
    return out.drop("_lp", "_lc")
