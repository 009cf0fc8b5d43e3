"""Registered queries for the replay path (R, F9-F10, J1-J3, J6-J8, V, G6-G9) on ``roll``."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.functions.rewards import all_missing, plain_score, weighted_reward
from rollwise.operators import replay as R
from rollwise.plans.fixtures import REWARDS, ROLL_SQL, roll
from rollwise.plans.flagship import FLAGSHIP, flagship, replay_advantages, replay_batch
from rollwise.plans.registry import register
from rollwise.sources.tables import read_table

GRP = "prompt_key, batch_step, batch_block"

# ----------------------------------------------------------------------------- SQL pieces


def _pos_sql() -> str:
    return "pos AS (SELECT *, row_number() OVER (PARTITION BY prompt_key ORDER BY seq) - 1 AS pos FROM roll WHERE mode = 'train')"


def _req_sql(cache: int) -> str:
    return f"""req AS (
  SELECT prompt_key, batch_step, batch_block, p0, least(p0, {cache}) AS buf_size FROM (
    SELECT prompt_key, batch_step, batch_block, min(p0b) OVER (PARTITION BY prompt_key, batch_step) AS p0
    FROM (SELECT prompt_key, step AS batch_step, block AS batch_block, min(pos) AS p0b FROM pos GROUP BY ALL)))"""


def _buf_sql(cache: int, gate: int) -> str:
    return f"""buf AS (
  SELECT q.prompt_key, q.batch_step, q.batch_block, q.p0, q.buf_size, p.rollout_id, p.seq, p.pos,
         p.pos - greatest(q.p0 - {cache}, 0) AS buf_idx, p.r_accuracy + p.r_format AS score
  FROM req q JOIN pos p ON p.prompt_key = q.prompt_key AND p.pos >= q.p0 - {cache} AND p.pos < q.p0
  WHERE q.buf_size >= {gate} AND q.buf_size > 0)"""


def _choose_sql(strategy: str, k: int, seed: int = 42) -> str:
    """CTE ``chosen(prompt_key, batch_step, batch_block, replay_slot, rollout_id)``."""
    part = f"PARTITION BY {GRP}"
    if strategy == "all":
        return f"chosen AS (SELECT {GRP}, buf_idx AS replay_slot, rollout_id FROM buf)"
    if strategy in ("highest_k", "random_k"):
        order = (
            "score DESC NULLS LAST, seq"
            if strategy == "highest_k"
            else f"md5(concat_ws(':', '{seed}', batch_step, batch_block, rollout_id)), seq"
        )
        return f"""chosen AS (
  SELECT {GRP}, replay_slot, rollout_id FROM (
    SELECT *, row_number() OVER ({part} ORDER BY {order}) - 1 AS replay_slot FROM buf)
  WHERE replay_slot < least(buf_size, {k}))"""
    if strategy == "recent_k":
        return f"""chosen AS (
  SELECT {GRP}, least(buf_size, {k}) - r AS replay_slot, rollout_id FROM (
    SELECT *, row_number() OVER ({part} ORDER BY seq DESC) AS r FROM buf)
  WHERE r <= least(buf_size, {k}))"""
    if strategy == "max_variance_k":
        return f"""sc AS (
  SELECT *, count(score) OVER ({part}) AS m, least(buf_size, {k}) AS kk0 FROM buf),
rk AS (
  SELECT *, CASE WHEN score IS NOT NULL THEN
           row_number() OVER (PARTITION BY {GRP}, score IS NULL ORDER BY score, seq) END AS lr,
         row_number() OVER (PARTITION BY {GRP}, score ORDER BY seq) AS o,
         row_number() OVER (PARTITION BY {GRP}, score IS NULL ORDER BY seq) AS ur
  FROM sc),
cands AS (SELECT DISTINCT {GRP}, m, least(kk0, m) AS kk FROM sc WHERE least(kk0, m) > 0),
ci AS (SELECT {GRP}, m, kk, unnest(generate_series(0, kk)) AS i FROM cands),
cs AS (
  SELECT c.prompt_key, c.batch_step, c.batch_block, c.m, c.kk, c.i,
         sum(r.score) AS s1, sum(r.score * r.score) AS s2
  FROM ci c JOIN rk r USING ({GRP})
  WHERE r.lr IS NOT NULL AND (r.lr <= c.i OR r.lr > c.m - (c.kk - c.i))
  GROUP BY ALL),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER ({part} ORDER BY kk * s2 - s1 * s1 DESC, s1 DESC, i) AS b FROM cs)
  WHERE b = 1),
pick AS (
  SELECT r.prompt_key, r.batch_step, r.batch_block, r.score, count(*) AS t
  FROM rk r JOIN best b USING ({GRP})
  WHERE r.lr IS NOT NULL AND (r.lr <= b.i OR r.lr > b.m - (b.kk - b.i))
  GROUP BY ALL),
chosen0 AS (
  SELECT r.* FROM rk r LEFT JOIN pick p USING ({GRP}, score)
  WHERE (r.score IS NOT NULL AND r.o <= coalesce(p.t, 0)) OR (r.score IS NULL AND r.ur <= r.kk0 - r.m)),
chosen AS (
  SELECT {GRP}, row_number() OVER ({part} ORDER BY seq) - 1 AS replay_slot, rollout_id FROM chosen0)"""
    raise ValueError(strategy)


def _replay_sql(strategy: str, k: int, gate: int, cache: int) -> str:
    return ",\n".join([ROLL_SQL, _pos_sql(), _req_sql(cache), _buf_sql(cache, gate), _choose_sql(strategy, k)])


def _batch_sql(strategy: str, k: int, gate: int, cache: int) -> str:
    """CTE ``batch``: online rows of every step plus replayed rows with their stored rewards."""
    online = (
        f"SELECT prompt_key, step AS batch_step, block AS batch_block, 1 AS is_online, CAST(slot AS BIGINT) AS batch_slot, "
        f"rollout_id, r_accuracy, r_format, completion_len, prompt_len, terminated FROM roll WHERE mode = 'train'"
    )
    if strategy == "none":
        return f"{ROLL_SQL},\nbatch AS ({online})"
    return (
        _replay_sql(strategy, k, gate, cache)
        + f""",
batch AS (
  {online}
  UNION ALL
  SELECT c.prompt_key, c.batch_step, c.batch_block, 0, CAST(c.replay_slot AS BIGINT), c.rollout_id, r.r_accuracy, r.r_format,
         r.completion_len, r.prompt_len, r.terminated
  FROM chosen c JOIN roll r USING (rollout_id))"""
    )


def _adv_sql(strategy: str, mode: str, k: int = 8, gate: int = 16, cache: int = 16, w=(1.0, 1.0)) -> str:
    keys = GRP + (", is_online" if mode == "split" else "")
    return f"""WITH {_batch_sql(strategy, k, gate, cache)},
rew AS (SELECT *, coalesce(r_accuracy * {w[0]}, 0) + coalesce(r_format * {w[1]}, 0) AS reward FROM batch)
SELECT {GRP}, is_online, batch_slot, rollout_id, reward,
       round((reward - avg(reward) OVER w) / (coalesce(stddev_samp(reward) OVER w, 0) + 1e-4), 6) AS advantage
FROM rew WINDOW w AS (PARTITION BY {keys})"""


def _adv_out(df):
    return df.select(
        "prompt_key", "batch_step", "batch_block", "is_online", "batch_slot", "rollout_id", "reward",
        F.round("advantage", 6).alias("advantage"),
    )


# ----------------------------------------------------------------------------- flagship + V


@register("v3_split_advantage", _adv_sql("highest_k", "split"))
def v3_split_advantage(spark, sf):
    """Flagship: highest_k (k=8, gate 16, cache 16), split advantages."""
    return flagship(roll(spark, sf))


@register("v2_mixed_advantage", _adv_sql("highest_k", "mixed"))
def v2_mixed_advantage(spark, sf):
    return _adv_out(replay_advantages(roll(spark, sf), FLAGSHIP, mode="mixed", position="fifo"))


@register("v1_group_advantage", _adv_sql("none", "none"))
def v1_group_advantage(spark, sf):
    cfg = R.ReplayConfig(strategy="none")
    return _adv_out(replay_advantages(roll(spark, sf), cfg, mode="none", position="fifo"))


@register("v5_group_of_one", _adv_sql("recent_k", "split", k=1, gate=8, cache=16))
def v5_group_of_one(spark, sf):
    """One replayed row per block: its split group has no sample std, advantage 0."""
    cfg = R.ReplayConfig(strategy="recent_k", num_replays=1, min_cache=8, max_cache=16)
    return _adv_out(replay_advantages(roll(spark, sf), cfg, mode="split", position="fifo"))


@register("v2_mixed_advantage_all", _adv_sql("all", "mixed", k=0, gate=4, cache=8))
def v2_mixed_advantage_all(spark, sf):
    """``all`` strategy with a partial-buffer gate, mixed groups."""
    cfg = R.ReplayConfig(strategy="all", num_replays=0, min_cache=4, max_cache=8)
    return _adv_out(replay_advantages(roll(spark, sf), cfg, mode="mixed", position="fifo"))


@register(
    "v1_unscaled_advantage",
    f"""WITH {_batch_sql("highest_k", 8, 16, 16)},
rew AS (SELECT *, coalesce(r_accuracy, 0) + coalesce(r_format, 0) AS reward FROM batch)
SELECT {GRP}, is_online, batch_slot, rollout_id, reward,
       round(reward - avg(reward) OVER (PARTITION BY {GRP}, is_online), 6) AS advantage
FROM rew""",
)
def v1_unscaled_advantage(spark, sf):
    """Rewards minus the group mean, not divided by the deviation."""
    return _adv_out(replay_advantages(roll(spark, sf), FLAGSHIP, mode="split", scale_rewards=False, position="fifo"))


# ----------------------------------------------------------------------------- R strategies


def _strategy_query(strategy: str, k: int, gate: int, cache: int):
    cfg = R.ReplayConfig(strategy=strategy, num_replays=k, min_cache=gate, max_cache=cache)

    def q(spark, sf):
        log = roll(spark, sf)
        pos_log = R.with_positions(log, position="fifo").withColumn("score", plain_score(REWARDS))
        out = R.replay_rows(pos_log, cfg)
        return out.select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id")

    sql = f"WITH {_replay_sql(strategy, k, gate, cache)}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen"
    return q, sql


for _name, _args in {
    "r3_all": ("all", 0, 8, 16),
    "r4_random_k": ("random_k", 8, 16, 16),
    "r5_highest_k": ("highest_k", 8, 16, 16),
    "r6_recent_k": ("recent_k", 8, 8, 16),
    "r7_max_variance_k": ("max_variance_k", 8, 16, 16),
    "r7_max_variance_k_partial": ("max_variance_k", 5, 8, 12),
}.items():
    _q, _sql = _strategy_query(*_args)
    register(_name, _sql)(_q)


@register(
    "r1_incremental_replay",
    f"WITH {_replay_sql('highest_k', 8, 16, 16)}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen WHERE batch_step >= 5",
)
def r1_incremental_replay(spark, sf):
    """Steps >= 5 from the FIFO snapshot after steps < 5 (not the whole history)."""
    pos = R.with_positions(roll(spark, sf), position="fifo").withColumn("score", plain_score(REWARDS))
    snapshot = R.fifo_state(pos.filter("step < 5"), FLAGSHIP.max_cache, seq="pos").drop("age")
    replays, _ = R.replay_increment(snapshot, pos.filter("step >= 5").drop("pos"), FLAGSHIP)
    return replays.select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id")


def _log_query(name: str, spark_log, step_sql: str, block_sql: str):
    """highest_k over a log numbered as a trainer numbers it; the SQL ranks by ``seq`` alone."""
    sql = ",\n".join(
        [
            ROLL_SQL,
            f"renumbered AS (SELECT * REPLACE ({step_sql} AS step, {block_sql} AS block) FROM roll)",
            _pos_sql().replace("FROM roll", "FROM renumbered"),
            _req_sql(16),
            _buf_sql(16, 16),
            _choose_sql("highest_k", 8),
        ]
    )

    def q(spark, sf):
        log = spark_log(roll(spark, sf)).drop("fifo")
        out = R.replay_rows(R.with_positions(log).withColumn("score", plain_score(REWARDS)), FLAGSHIP)
        return out.select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id")

    register(name, f"WITH {sql}\nSELECT {GRP}, replay_slot, rollout_id FROM chosen")(q)


# Global steps: a prompt is seen at steps far apart (37, 293, 549, ...).
_log_query(
    "r5_global_step_log",
    lambda log: log.withColumn("step", F.col("visit") * 256 + F.col("prompt_key") % 256),
    "visit * 256 + prompt_key % 256",
    "block",
)
# Two blocks per step: both read the buffer as it was before the step.
_log_query(
    "r5_two_blocks",
    lambda log: log.withColumn("step", F.floor(F.col("visit") / 2).cast("bigint")).withColumn("block", (F.col("visit") % 2).cast("int")),
    "CAST(visit // 2 AS BIGINT)",
    "CAST(visit % 2 AS INTEGER)",
)


@register(
    "r1_fifo_state",
    f"""WITH {ROLL_SQL}
SELECT prompt_key, rollout_id, seq, age FROM (
  SELECT *, row_number() OVER (PARTITION BY prompt_key ORDER BY seq DESC) - 1 AS age FROM roll)
WHERE age < 16""",
)
def r1_fifo_state(spark, sf):
    return R.fifo_state(roll(spark, sf), 16).select("prompt_key", "rollout_id", "seq", "age")


@register(
    "j2_buffer_asof",
    f"""WITH {ROLL_SQL}, {_pos_sql()}, {_req_sql(16)}, {_buf_sql(16, 0)}
SELECT {GRP}, buf_size, rollout_id, buf_idx FROM buf""",
)
def j2_buffer_asof(spark, sf):
    pos_log = R.with_positions(roll(spark, sf), position="fifo")
    req = R.buffer_requests(pos_log, 16)
    return R.buffer_asof(pos_log, req, 16).select(
        "prompt_key", "batch_step", "batch_block", "buf_size", "rollout_id", "buf_idx"
    )


@register(
    "f9_gate",
    f"""WITH {ROLL_SQL}, {_pos_sql()}, {_req_sql(16)}
SELECT {GRP}, p0, buf_size FROM req WHERE buf_size >= 12""",
)
def f9_gate(spark, sf):
    pos_log = R.with_positions(roll(spark, sf))
    return R.gate(R.buffer_requests(pos_log, 16), 12).select(
        "prompt_key", "batch_step", "batch_block", "p0", "buf_size"
    )


@register(
    "r8_merge",
    f"""WITH {_batch_sql("highest_k", 8, 16, 16)}
SELECT {GRP}, is_online, batch_slot, rollout_id, r_accuracy, r_format FROM batch""",
)
def r8_merge(spark, sf):
    return replay_batch(roll(spark, sf), FLAGSHIP, position="fifo").select(
        "prompt_key", "batch_step", "batch_block", "is_online", "batch_slot", "rollout_id", "r_accuracy", "r_format"
    )


@register(
    "r8_merge_max_variance",
    f"""WITH {_batch_sql("max_variance_k", 8, 16, 16)}
SELECT {GRP}, is_online, batch_slot, rollout_id, r_accuracy, r_format FROM batch""",
)
def r8_merge_max_variance(spark, sf):
    cfg = R.ReplayConfig(strategy="max_variance_k", num_replays=8, min_cache=16, max_cache=16)
    return replay_batch(roll(spark, sf), cfg, position="fifo").select(
        "prompt_key", "batch_step", "batch_block", "is_online", "batch_slot", "rollout_id", "r_accuracy", "r_format"
    )


@register(
    "r9_no_replay",
    f"""WITH {_batch_sql("none", 0, 0, 16)}
SELECT {GRP}, is_online, batch_slot, rollout_id, r_accuracy, r_format FROM batch""",
)
def r9_no_replay(spark, sf):
    return replay_batch(roll(spark, sf), R.ReplayConfig(strategy="none"), position="fifo").select(
        "prompt_key", "batch_step", "batch_block", "is_online", "batch_slot", "rollout_id", "r_accuracy", "r_format"
    )


@register(
    "f10_online_offline",
    f"""WITH {_batch_sql("highest_k", 8, 16, 16)}
SELECT is_online, count(*) AS n_rows, count(DISTINCT prompt_key) AS n_prompts FROM batch GROUP BY is_online""",
)
def f10_online_offline(spark, sf):
    b = replay_batch(roll(spark, sf), FLAGSHIP, position="fifo")
    return b.groupBy("is_online").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("prompt_key").alias("n_prompts")
    )


@register(
    "r10_replay_ledger",
    f"""WITH {_replay_sql("highest_k", 8, 16, 16)}
SELECT batch_step, count(*) AS replay_rows, count(DISTINCT prompt_key) AS prompts_replayed FROM chosen GROUP BY batch_step""",
)
def r10_replay_ledger(spark, sf):
    pos_log = R.with_positions(roll(spark, sf), position="fifo").withColumn("score", plain_score(REWARDS))
    return R.replay_ledger(R.replay_rows(pos_log, FLAGSHIP))


# ----------------------------------------------------------------------------- joins


def _prompts(spark, sf):
    """Prompt table for J1/J3: one row per user of the log (customers stand in for prompts)."""
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("prompt_key"), F.col("c_name").alias("prompt"), F.col("c_mktsegment").alias("segment")
    )


@register(
    "j1_rollout_prompt_join",
    f"""WITH {ROLL_SQL}
SELECT r.rollout_id, r.prompt_key, c.c_name AS prompt, r.completion, c.c_mktsegment AS segment
FROM roll r JOIN customer c ON c.c_custkey = r.prompt_key""",
)
def j1_rollout_prompt_join(spark, sf):
    return roll(spark, sf).join(_prompts(spark, sf), "prompt_key").select("rollout_id", "prompt_key", "prompt", "completion", "segment")


@register(
    "j3_replay_inputs",
    f"""WITH {_replay_sql("highest_k", 8, 16, 16)}
SELECT c.prompt_key, c.batch_step, c.replay_slot, c.rollout_id, cu.c_name AS prompt, cu.c_mktsegment AS segment
FROM chosen c JOIN customer cu ON cu.c_custkey = c.prompt_key""",
)
def j3_replay_inputs(spark, sf):
    pos_log = R.with_positions(roll(spark, sf), position="fifo").withColumn("score", plain_score(REWARDS))
    rep = R.replay_rows(pos_log, FLAGSHIP)
    return rep.join(_prompts(spark, sf), "prompt_key").select("prompt_key", "batch_step", "replay_slot", "rollout_id", "prompt", "segment")


@register(
    "j6_payload_fetch",
    f"""WITH {_replay_sql("recent_k", 4, 8, 16)}
SELECT c.prompt_key, c.batch_step, c.replay_slot, c.rollout_id, r.completion, r.completion_len, r.terminated
FROM chosen c JOIN roll r USING (rollout_id)""",
)
def j6_payload_fetch(spark, sf):
    log = roll(spark, sf)
    cfg = R.ReplayConfig(strategy="recent_k", num_replays=4, min_cache=8, max_cache=16)
    rep = R.replay_rows(R.with_positions(log, position="fifo").withColumn("score", plain_score(REWARDS)), cfg)
    payload = log.select("rollout_id", "completion", "completion_len", "terminated")
    return rep.select("prompt_key", "batch_step", "replay_slot", "rollout_id").join(payload, "rollout_id")


@register(
    "j7_prompt_agreement",
    f"""WITH {_replay_sql("highest_k", 8, 16, 16)}
SELECT c.prompt_key, c.batch_step, count(*) AS unmatched FROM chosen c
WHERE NOT EXISTS (SELECT 1 FROM roll r WHERE r.prompt_key = c.prompt_key AND r.step = c.batch_step AND r.step % 7 <> 3)
GROUP BY ALL""",
)
def j7_prompt_agreement(spark, sf):
    log = roll(spark, sf)
    rep = R.replay_rows(R.with_positions(log, position="fifo").withColumn("score", plain_score(REWARDS)), FLAGSHIP)
    batch = log.filter("step % 7 <> 3")  # a batch that lost the online blocks of some steps
    return R.unmatched_replays(rep, batch).groupBy("prompt_key", "batch_step").agg(F.count(F.lit(1)).alias("unmatched"))


@register(
    "j8_cache_divergence",
    f"""WITH {ROLL_SQL},
a AS (SELECT prompt_key, list(completion ORDER BY seq) AS c, list(seq ORDER BY seq) AS q FROM (
        SELECT *, row_number() OVER (PARTITION BY prompt_key ORDER BY seq DESC) AS rn FROM roll) WHERE rn <= 16 GROUP BY prompt_key),
b AS (SELECT prompt_key, list(completion ORDER BY seq) AS c, list(seq ORDER BY seq) AS q FROM (
        SELECT *, row_number() OVER (PARTITION BY prompt_key ORDER BY seq DESC) AS rn FROM roll WHERE completion <> 'error')
        WHERE rn <= 16 GROUP BY prompt_key)
SELECT coalesce(a.prompt_key, b.prompt_key) AS prompt_key, CAST(to_json(a.c) AS VARCHAR) AS completions_a, CAST(to_json(b.c) AS VARCHAR) AS completions_b
FROM a FULL OUTER JOIN b ON a.prompt_key = b.prompt_key
WHERE a.c IS DISTINCT FROM b.c OR a.q IS DISTINCT FROM b.q""",
)
def j8_cache_divergence(spark, sf):
    """Two cache replicas, one of which never saw the error rollouts; report prompts that differ."""
    log = roll(spark, sf)
    out = R.cache_divergence(R.fifo_state(log, 16), R.fifo_state(log.filter(F.col("completion") != "error"), 16), ("completion",))
    return out.select(
        "prompt_key",
        F.to_json("contents_a.completion").alias("completions_a"),
        F.to_json("contents_b.completion").alias("completions_b"),
    )


# ----------------------------------------------------------------------------- rewards


@register(
    "g6_reward_matrix",
    f"""WITH {ROLL_SQL}
SELECT step, count(r_accuracy) AS n_accuracy, count(r_format) AS n_format, count(*) AS n_rows,
       sum(r_accuracy) AS sum_accuracy, sum(r_format) AS sum_format FROM roll GROUP BY step""",
)
def g6_reward_matrix(spark, sf):
    return roll(spark, sf).groupBy("step").agg(
        F.count("r_accuracy").alias("n_accuracy"),
        F.count("r_format").alias("n_format"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("r_accuracy").alias("sum_accuracy"),
        F.sum("r_format").alias("sum_format"),
    )


@register(
    "g7_weighted_reward",
    f"""WITH {ROLL_SQL}
SELECT rollout_id, coalesce(r_accuracy * 1.0, 0) + coalesce(r_format * 0.5, 0) AS reward FROM roll""",
)
def g7_weighted_reward(spark, sf):
    return roll(spark, sf).select("rollout_id", weighted_reward(REWARDS, [1.0, 0.5]).alias("reward"))


@register(
    "g8_replay_score",
    f"""WITH {ROLL_SQL}
SELECT rollout_id, r_accuracy + r_format AS score FROM roll""",
)
def g8_replay_score(spark, sf):
    return roll(spark, sf).select("rollout_id", plain_score(REWARDS).alias("score"))


@register(
    "g9_missing_rewards",
    f"""WITH {ROLL_SQL}
SELECT step, count(*) FILTER (WHERE r_accuracy IS NULL OR r_format IS NULL) AS any_missing,
       count(*) FILTER (WHERE coalesce(r_accuracy, r_format) IS NULL) AS all_missing,
       count(*) FILTER (WHERE r_accuracy IS NULL) AS accuracy_missing
FROM roll GROUP BY step""",
)
def g9_missing_rewards(spark, sf):
    log = roll(spark, sf)
    any_missing = F.col("r_accuracy").isNull() | F.col("r_format").isNull()
    return log.groupBy("step").agg(
        F.count(F.when(any_missing, 1)).alias("any_missing"),
        F.count(F.when(all_missing(REWARDS), 1)).alias("all_missing"),
        F.count(F.when(F.col("r_accuracy").isNull(), 1)).alias("accuracy_missing"),
    )

