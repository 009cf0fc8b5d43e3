"""Registered streaming queries (ST1-ST4): the rollout log is staged as ordered appends under
the checkpoint folder, streamed with ``availableNow``, and the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.functions.rewards import plain_score, weighted_reward
from rollwise.operators.replay import ReplayConfig
from rollwise.plans.fixtures import REWARDS, ROLL_SQL, roll
from rollwise.plans.q_replay import GRP, _replay_sql
from rollwise.plans.registry import ORACLE_SQL, register
from rollwise.streaming import replay_cache as RC
from rollwise.streaming import replay_tables as RT
from rollwise.streaming import runner

CHUNKS = 5


def _scored_roll(spark, sf, renumber=None):
    return (renumber or (lambda x: x))(roll(spark, sf)).withColumn("score", plain_score(REWARDS)).withColumn("reward", weighted_reward(REWARDS))


def _staged_roll(spark, sf, name):
    log, base = _scored_roll(spark, sf), runner.run_folder(spark, name)
    glob = runner.stage_in_order(log, f"{base}/source", "seq", CHUNKS)
    return base, runner.file_stream(spark, glob, log.schema)


def _replay_stream_query(name: str, eval_every=None, strategy: str = "highest_k", renumber=None):
    cfg = ReplayConfig(strategy=strategy, num_replays=8, min_cache=16, max_cache=16)

    def q(spark, sf):
        log, base = _scored_roll(spark, sf, renumber), runner.run_folder(spark, name)
        if eval_every:
            log = log.withColumn("mode", F.when(F.col("prompt_key") % eval_every == 0, "eval").otherwise("train"))
        # A trigger is one append, in however many files: files of an append come in no order.
        for glob in runner.appends_in_order(log, f"{base}/source", "seq", CHUNKS):
            out = RC.streaming_replays(runner.file_stream(spark, glob, log.schema, max_files=None), cfg)
            runner.append_to_parquet(out, f"{base}/sink", f"{base}/checkpoint")
        return spark.read.parquet(f"{base}/sink").select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id")

    return q


register(
    "st1_stream_replay",
    f"WITH {_replay_sql('highest_k', 8, 16, 16)}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen",
)(_replay_stream_query("st1"))

register(
    "st4_stream_routing",
    f"WITH {_replay_sql('highest_k', 8, 16, 16)}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen WHERE prompt_key % 5 <> 0",
)(_replay_stream_query("st4", eval_every=5))


register(
    "st1_stream_replay_max_variance",
    f"WITH {_replay_sql('max_variance_k', 8, 16, 16)}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen",
)(_replay_stream_query("st1mv", strategy="max_variance_k"))

register(
    "st1_stream_replay_random",
    f"WITH {_replay_sql('random_k', 8, 16, 16)}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen",
)(_replay_stream_query("st1rk", strategy="random_k"))


# String keys, as the canonical log has them.
register(
    "st1_stream_string_key",
    f"""WITH {_replay_sql('highest_k', 8, 16, 16)}
SELECT 'p' || prompt_key AS prompt_key, batch_step, batch_block, replay_slot, rollout_id FROM chosen""",
)(_replay_stream_query("st1sk", renumber=lambda log: log.withColumn("prompt_key", F.concat(F.lit("p"), F.col("prompt_key").cast("string")))))

def _two_blocks(log):
    return log.withColumn("step", F.floor(F.col("visit") / 2).cast("bigint")).withColumn("block", (F.col("visit") % 2).cast("int"))


# Two blocks per step, whose rows may come in different triggers.
register("st1_stream_two_blocks", ORACLE_SQL["r5_two_blocks"])(_replay_stream_query("st1tb", renumber=_two_blocks))


def _table_query(name: str, renumber=None):
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)

    def q(spark, sf):
        log, base = _scored_roll(spark, sf, renumber), runner.run_folder(spark, name)
        # A trigger is one append here too; it costs several jobs whatever its size.
        for glob in runner.appends_in_order(log, f"{base}/source", "seq", CHUNKS):
            replays = RT.run_replays(runner.file_stream(spark, glob, log.schema, max_files=None), cfg, f"{base}/replay")
        return replays

    return q


# The same with the buffers in a table, for prompts with many rows in one trigger.
register("st1_table_replay", ORACLE_SQL["st1_stream_replay"])(_table_query("st1t"))
register("st1_table_two_blocks", ORACLE_SQL["r5_two_blocks"])(_table_query("st1ttb", renumber=_two_blocks))


@register(
    "st2_stream_ingest",
    f"WITH {ROLL_SQL}\nSELECT rollout_id, prompt_key, step, slot, seq FROM roll",
)
def st2_stream_ingest(spark, sf):
    base, stream = _staged_roll(spark, sf, "st2")
    runner.append_to_parquet(stream.select("rollout_id", "prompt_key", "step", "slot", "seq"), f"{base}/sink", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/sink")


@register(
    "st3_stream_step_metrics",
    f"""WITH {ROLL_SQL}
SELECT mode, step, count(*) AS n_rows, round(sum(coalesce(r_accuracy, 0) + coalesce(r_format, 0)), 6) AS reward_sum,
       round(avg(coalesce(r_accuracy, 0) + coalesce(r_format, 0)), 6) AS reward_mean, CAST(sum(completion_len) AS BIGINT) AS tokens
FROM roll GROUP BY mode, step""",
)
def st3_stream_step_metrics(spark, sf):
    base, stream = _staged_roll(spark, sf, "st3")
    runner.complete_to_parquet(RC.step_metrics_stream(stream), f"{base}/sink", f"{base}/checkpoint")
    out = spark.read.parquet(f"{base}/sink")
    return out.select(
        "mode", "step", "n_rows", F.round("reward_sum", 6).alias("reward_sum"),
        F.round("reward_mean", 6).alias("reward_mean"), "tokens",
    )
