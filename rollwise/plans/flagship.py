"""The flagship slice: rollout log -> as-of buffer -> gate -> strategy -> merge -> advantages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.functions.rewards import plain_score, weighted_reward
from rollwise.operators import replay as R
from rollwise.operators.advantage import advantages
from rollwise.plans.fixtures import REWARDS


def _batch_parts(
    log: DataFrame, cfg: R.ReplayConfig, *, rewards=REWARDS, payload=(), position: str | None = None
) -> tuple[DataFrame, DataFrame]:
    cfg.validate()
    cols = (*rewards, *payload)
    online = log.filter(F.col("mode").isin(*cfg.modes)) if cfg.modes else log
    if cfg.strategy == "none":  # R9: no replay side; an empty relation the optimizer drops
        replays = online.select(
            "prompt_key",
            F.lit(0).cast("bigint").alias("batch_step"),
            F.lit(0).alias("batch_block"),
            F.lit(0).cast("bigint").alias("replay_slot"),
            "rollout_id",
            *cols,
        ).limit(0)
    else:
        pos_log = R.with_positions(log, modes=cfg.modes, position=position).withColumn("score", plain_score(rewards))
        # Buffers carry ids and scores (and the rewards, where nothing else is wanted); any
        # payload is fetched by id for the chosen rows.
        replays = R.replay_rows(pos_log, cfg, carry=() if payload else tuple(rewards))
        return R.merge_parts(online, replays, log if payload else None, columns=cols)
    return R.merge_parts(online, replays, None, columns=cols)


def replay_batch(
    log: DataFrame, cfg: R.ReplayConfig, *, rewards=REWARDS, payload=(), position: str | None = None
) -> DataFrame:
    """Merged training batch (R8): online rows of every step plus the rows replayed into it.

    ``position`` names a column with each row's append number, where the log has one.
    """
    on, off = _batch_parts(log, cfg, rewards=rewards, payload=payload, position=position)
    return on.unionByName(off)


def replay_advantages(
    log: DataFrame,
    cfg: R.ReplayConfig,
    *,
    mode: str = "split",
    rewards=REWARDS,
    weights=None,
    scale_rewards: bool = True,
    position: str | None = None,
    payload=(),
) -> DataFrame:
    """Merged batch with ``reward`` and ``advantage``.

    In ``split`` mode fresh and replayed rows never share a group, so each side is normalised
    before the union: the replayed side is still hash-partitioned by (prompt, step, block)
    from the strategy stage, and its advantage window needs no further shuffle.
    """
    reward = weighted_reward(rewards, weights)
    if mode == "split":
        on, off = _batch_parts(log, cfg, rewards=rewards, payload=payload, position=position)
        on = advantages(on.withColumn("reward", reward), mode, scale_rewards=scale_rewards)
        off = advantages(off.withColumn("reward", reward), mode, scale_rewards=scale_rewards)
        return on.unionByName(off)
    batch = replay_batch(log, cfg, rewards=rewards, payload=payload, position=position)
    return advantages(batch.withColumn("reward", reward), mode, scale_rewards=scale_rewards)


FLAGSHIP = R.ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)


def flagship(log: DataFrame, position: str | None = "fifo") -> DataFrame:
    out = replay_advantages(log, FLAGSHIP, mode="split", position=position)
    return out.select(
        "prompt_key",
        "batch_step",
        "batch_block",
        "is_online",
        "batch_slot",
        "rollout_id",
        "reward",
        F.round("advantage", 6).alias("advantage"),
    )
