"""Registered queries for training metrics (A1-A8) on the flagship batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.functions.rewards import weighted_reward
from rollwise.operators import metrics as M
from rollwise.plans.fixtures import G, REWARDS, roll
from rollwise.plans.flagship import FLAGSHIP, replay_batch
from rollwise.plans.q_replay import _batch_sql
from rollwise.plans.registry import register


def _batch(spark, sf, eval_every: int | None = None):
    b = replay_batch(roll(spark, sf), FLAGSHIP, payload=("completion_len", "prompt_len", "terminated"), position="fifo")
    b = b.withColumn("reward", weighted_reward(REWARDS))
    mode = F.lit("train")
    if eval_every:
        mode = F.when(F.col("prompt_key") % eval_every == 0, F.lit("eval")).otherwise(F.lit("train"))
    return b.withColumn("mode", mode)


def _q(name: str) -> str:
    return '"' + name + '"'


def _wide_sql(eval_every: int | None = None) -> str:
    mode = f"CASE WHEN prompt_key % {eval_every} = 0 THEN 'eval' ELSE 'train' END" if eval_every else "'train'"
    per_reward = []
    for r in REWARDS:
        on, off = "FILTER (WHERE is_online = 1)", "FILTER (WHERE is_online = 0)"
        per_reward += [
            f"avg({r}) {on} AS {_q(f'rewards/{r}/online_mean')}",
            f"stddev_samp({r}) {on} AS {_q(f'rewards/{r}/online_std')}",
            f"CASE WHEN count(*) {off} > 0 THEN avg({r}) {off} ELSE 0.0 END AS {_q(f'rewards/{r}/offline_mean')}",
            f"CASE WHEN count(*) {off} > 0 THEN stddev_samp({r}) {off} ELSE 0.0 END AS {_q(f'rewards/{r}/offline_std')}",
            f"min({r}) AS {_q(f'rewards/{r}/min')}",
            f"max({r}) AS {_q(f'rewards/{r}/max')}",
        ]
    t = "FILTER (WHERE terminated)"
    per_row = per_reward + [
        f"CAST(avg(completion_len) AS DOUBLE) AS {_q('completions/mean_length')}",
        f"CAST(min(completion_len) AS DOUBLE) AS {_q('completions/min_length')}",
        f"CAST(max(completion_len) AS DOUBLE) AS {_q('completions/max_length')}",
        f"1.0 - count(*) {t} / count(*) AS {_q('completions/clipped_ratio')}",
        f"CAST(coalesce(avg(completion_len) {t}, 0.0) AS DOUBLE) AS {_q('completions/mean_terminated_length')}",
        f"CAST(coalesce(min(completion_len) {t}, 0) AS DOUBLE) AS {_q('completions/min_terminated_length')}",
        f"CAST(coalesce(max(completion_len) {t}, 0) AS DOUBLE) AS {_q('completions/max_terminated_length')}",
        "CAST(sum(CASE WHEN mode = 'train' THEN completion_len + prompt_len ELSE 0 END) AS DOUBLE) AS st",
    ]
    on, off = "FILTER (WHERE is_online = 1)", "FILTER (WHERE is_online = 0)"
    per_group = [
        f"avg(gm) {on} AS {_q('reward/online')}",
        f"avg(gs) {on} AS {_q('reward/online_std')}",
        f"CASE WHEN count(*) {off} > 0 THEN avg(gm) {off} ELSE 0.0 END AS {_q('reward/offline')}",
        f"CASE WHEN count(*) {off} > 0 THEN avg(gs) {off} ELSE 0.0 END AS {_q('reward/offline_std')}",
    ]
    return f"""WITH {_batch_sql("highest_k", 8, 16, 16)},
b AS (SELECT *, coalesce(r_accuracy, 0) + coalesce(r_format, 0) AS reward, {mode} AS mode FROM batch),
rows_ AS (SELECT mode, batch_step AS step, {", ".join(per_row)} FROM b GROUP BY ALL),
grp AS (SELECT mode, batch_step, prompt_key, batch_block, is_online, avg(reward) AS gm, coalesce(stddev_samp(reward), 0) AS gs
        FROM b GROUP BY ALL),
groups_ AS (SELECT mode, batch_step AS step, {", ".join(per_group)} FROM grp GROUP BY ALL),
wide AS (
  SELECT r.* EXCLUDE (st), g.* EXCLUDE (mode, step),
         (SELECT sum(t.st) FROM rows_ t WHERE t.step <= r.step) AS num_tokens
  FROM rows_ r JOIN groups_ g USING (mode, step)),
long AS (SELECT mode, step, metric, CAST(value AS DOUBLE) AS value
         FROM (FROM wide UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(* EXCLUDE (mode, step))))))"""


def _long(spark, sf, eval_every=None):
    return M.to_long(M.step_metrics(_batch(spark, sf, eval_every), REWARDS, prompt_length="prompt_len"))


_GROUPS = {
    "a1_reward_stats": "metric LIKE 'rewards/%/o%'",
    "a2_nanmin_max": "(metric LIKE 'rewards/%/min' OR metric LIKE 'rewards/%/max')",
    "a3_group_mean_std": "metric LIKE 'reward/%'",
    "a4_offline_default": "metric LIKE '%offline%'",
    "a5_length_stats": "metric IN ('completions/mean_length', 'completions/min_length', 'completions/max_length')",
    "a6_terminated_stats": "(metric LIKE 'completions/%terminated%' OR metric = 'completions/clipped_ratio')",
    "a7_tokens_seen": "metric = 'num_tokens'",
}


def _metric_filter(where: str):
    """The same predicate in Spark, for the metric-name groups above."""
    return F.expr(where)


def _group_query(where: str):
    def q(spark, sf):
        long = _long(spark, sf).filter(_metric_filter(where))
        return long.select("mode", "step", "metric", F.round("value", 6).alias("value"))

    return q


for _name, _where in _GROUPS.items():
    register(_name, f"{_wide_sql()}\nSELECT mode, step, metric, round(value, 6) AS value FROM long WHERE {_where}")(
        _group_query(_where)
    )


@register(
    "a8_logging_window",
    f"""{_wide_sql(eval_every=5)}
SELECT mode, CAST(floor(step / 5) AS BIGINT) AS window,
       CASE WHEN mode = 'eval' THEN 'eval_' || metric ELSE metric END AS metric,
       round(CASE WHEN metric = 'num_tokens' THEN arg_max(value, step) ELSE avg(value) END, 6) AS value
FROM long GROUP BY mode, floor(step / 5), metric""",
)
def a8_logging_window(spark, sf):
    w = M.logging_window(_long(spark, sf, eval_every=5), every=5)
    return w.select("mode", "window", "metric", F.round("value", 6).alias("value"))


@register(
    "a7_tokens_seen_eval",
    f"{_wide_sql(eval_every=5)}\nSELECT mode, step, round(value, 6) AS value FROM long WHERE metric = 'num_tokens'",
)
def a7_tokens_seen_eval(spark, sf):
    """Eval steps show the training tokens seen so far."""
    return _long(spark, sf, eval_every=5).filter("metric = 'num_tokens'").select("mode", "step", F.round("value", 6).alias("value"))
