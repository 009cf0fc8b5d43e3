"""Clipped-surrogate loss analytics from stored per-token log-probabilities.

Per row, one ``aggregate`` pass over the masked token arrays yields every token sum the
batch metrics need; the batch level is one grouped aggregation of those sums with
conditional (on-/off-policy) terms. No Python runs on executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_TYPES = ("grpo", "bnpo", "dr_grpo")


@dataclass(frozen=True)
class LossConfig:
    epsilon: float = 0.2
    epsilon_high: float | None = None
    beta: float = 0.04
    loss_type: str = "grpo"
    max_completion_length: int = 1024
    off_policy_coef: float = 1.0
    replay: bool = True  # False when the replay strategy is ``none``: the off-policy part is 0

    @property
    def eps_low(self) -> float:
        return self.epsilon

    @property
    def eps_high(self) -> float:
        return self.epsilon if self.epsilon_high is None else self.epsilon_high

    def validate(self) -> "LossConfig":
        if self.loss_type not in LOSS_TYPES:
            raise ValueError(f"unknown loss type {self.loss_type!r}; expected one of {LOSS_TYPES}")
        return self


def ratio(now: Column, old: Column) -> Column:
    """L1: importance ratio of one token."""
    return F.exp(now - old)


def clipped(r: Column, cfg: LossConfig) -> Column:
    """L1: ratio clamped to ``[1 - eps_low, 1 + eps_high]``."""
    return F.least(F.greatest(r, F.lit(1.0 - cfg.eps_low)), F.lit(1.0 + cfg.eps_high))


def token_loss(r: Column, adv: Column, cfg: LossConfig) -> Column:
    """L2: ``-min(ratio * A, clip(ratio) * A)``."""
    return -F.least(r * adv, clipped(r, cfg) * adv)


def token_sums(
    df: DataFrame,
    cfg: LossConfig,
    *,
    now: str = "logp_now",
    old: str = "logp_old",
    ref: str | None = "ref_logp",
    mask_len: str = "mask_len",
    adv: str = "advantage",
) -> DataFrame:
    """Per row: masked token count and sums of loss, ratio, clip, KL and clip-region counts."""
    cfg.validate()
    n = F.least(F.col(mask_len), F.size(now))
    arrays = [F.slice(now, 1, n).alias("a"), F.slice(old, 1, n).alias("b")]
    use_kl = cfg.beta != 0.0 and ref is not None
    if use_kl:
        arrays.append(F.slice(ref, 1, n).alias("r"))
    z = F.arrays_zip(*arrays)
    A = F.col(adv)
    zero = F.struct(
        F.lit(0.0).alias("loss"),
        F.lit(0.0).alias("ratio"),
        F.lit(0.0).alias("clip"),
        F.lit(0.0).alias("kl"),
        F.lit(0).cast("bigint").alias("low"),
        F.lit(0).cast("bigint").alias("high"),
        F.lit(0).cast("bigint").alias("region"),
    )

    def step(acc, t):
        r = ratio(t["a"], t["b"])
        lo = (r < F.lit(1.0 - cfg.eps_low)) & (A < 0)
        hi = (r > F.lit(1.0 + cfg.eps_high)) & (A > 0)
        d = (t["r"] - t["a"]) if use_kl else F.lit(0.0)
        kl = (F.exp(d) - d - F.lit(1.0)) if use_kl else F.lit(0.0)
        return F.struct(
            (acc["loss"] + token_loss(r, A, cfg)).alias("loss"),
            (acc["ratio"] + r).alias("ratio"),
            (acc["clip"] + clipped(r, cfg)).alias("clip"),
            (acc["kl"] + kl).alias("kl"),
            (acc["low"] + lo.cast("bigint")).alias("low"),
            (acc["high"] + hi.cast("bigint")).alias("high"),
            (acc["region"] + (lo | hi).cast("bigint")).alias("region"),
        )

    s = F.aggregate(z, zero, step)
    return df.withColumn("tok_n", F.size(z).cast("bigint")).withColumn("_s", s).select(
        "*",
        F.col("_s.loss").alias("loss_sum"),
        F.col("_s.ratio").alias("ratio_sum"),
        F.col("_s.clip").alias("clip_sum"),
        F.col("_s.kl").alias("kl_sum"),
        F.col("_s.low").alias("n_low"),
        F.col("_s.high").alias("n_high"),
        F.col("_s.region").alias("n_region"),
    ).drop("_s")


def _on(c: Column, online: int) -> Column:
    return F.when(F.col("is_online") == online, c)


def batch_losses(sums: DataFrame, cfg: LossConfig, group: tuple[str, ...] = ("batch",)) -> DataFrame:
    """L3-L6 per batch: on/off losses for the configured flavour, KL, total, clip fractions."""
    cfg.validate()
    rows = F.count(F.lit(1))
    on_tok = F.coalesce(F.sum(_on(F.col("tok_n"), 1)), F.lit(0))
    off_tok = F.coalesce(F.sum(_on(F.col("tok_n"), 0)), F.lit(0))
    all_tok = F.sum("tok_n")
    seq_mean = F.col("loss_sum") / F.greatest(F.col("tok_n"), F.lit(1))

    def flavour(online: int, tok: Column) -> Column:
        if cfg.loss_type == "grpo":  # mean over all rows of per-row masked means (X17)
            return F.coalesce(F.sum(_on(seq_mean, online)), F.lit(0.0)) / rows
        if cfg.loss_type == "bnpo":
            return F.coalesce(F.sum(_on(F.col("loss_sum"), online)), F.lit(0.0)) / F.greatest(tok, F.lit(1))
        return F.coalesce(F.sum(_on(F.col("loss_sum"), online)), F.lit(0.0)) / (rows * F.lit(cfg.max_completion_length))

    has_off = (off_tok > 0) & F.lit(cfg.replay)

    def frac(c: str, online: int | None, den: Column) -> Column:
        num = F.sum(c) if online is None else F.coalesce(F.sum(_on(F.col(c), online)), F.lit(0))
        return num / F.greatest(den, F.lit(1))

    aggs = [
        flavour(1, on_tok).alias("on_loss"),
        F.when(has_off, flavour(0, off_tok)).otherwise(F.lit(0.0)).alias("off_loss"),
        (F.coalesce(F.sum(_on(F.col("kl_sum"), 1)), F.lit(0.0)) / F.greatest(on_tok, F.lit(1))).alias("kl"),
    ]
    for kind in ("low", "high", "region"):
        aggs += [
            frac(f"n_{kind}", None, all_tok).alias(f"clip_overall_{kind}"),
            frac(f"n_{kind}", 1, on_tok).alias(f"clip_on_{kind}"),
            F.when(has_off, frac(f"n_{kind}", 0, off_tok)).otherwise(F.lit(0.0)).alias(f"clip_off_{kind}"),
        ]
    out = sums.groupBy(*group).agg(*aggs)
    on_total = F.col("on_loss") + (F.lit(cfg.beta) * F.col("kl") if cfg.beta != 0.0 else F.lit(0.0))
    out = out.withColumn("on_total", on_total)  # reported as the on-policy loss: the KL term is part of it
    return out.withColumn("loss", F.col("on_total") + F.lit(cfg.off_policy_coef) * F.col("off_loss"))


# The names the loss metrics are reported under.
METRIC_NAMES = {
    "on_total": "loss/on_policy",
    "off_loss": "loss/off_policy",
    "kl": "kl",
    "clip_overall_low": "clip_ratio/overall_low",
    "clip_overall_high": "clip_ratio/overall_high",
    "clip_overall_region": "clip_ratio/overall_region",
    "clip_on_low": "clip_ratio/on_low",
    "clip_on_high": "clip_ratio/on_high",
    "clip_on_region": "clip_ratio/on_region",
    "clip_off_low": "clip_ratio/off_low",
    "clip_off_high": "clip_ratio/off_high",
    "clip_off_region": "clip_ratio/off_region",
}


def loss_metrics(losses: DataFrame, cfg: LossConfig, group: tuple[str, ...] = ("batch",)) -> DataFrame:
    """The batch losses as the metric long table; ``kl`` only when beta is not 0."""
    names = {k: v for k, v in METRIC_NAMES.items() if k != "kl" or cfg.beta != 0.0}
    items = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(k).alias("value")) for k, v in names.items()])
    return losses.select(*group, F.explode(items).alias("m")).select(*group, "m.metric", "m.value")
