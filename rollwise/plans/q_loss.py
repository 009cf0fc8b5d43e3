"""Registered queries for token arrays (F3-F8) and policy-loss analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.operators import loss as L
from rollwise.operators import tokens as TK
from rollwise.operators.replay import ReplayConfig
from rollwise.plans import jobs
from rollwise.plans.fixtures import IDS_SQL, ROLL_SQL, TOK_SQL, ids, roll, tok
from rollwise.plans.q_replay import GRP, _buf_sql, _choose_sql, _pos_sql, _req_sql
from rollwise.plans.registry import register
from rollwise.sources.tables import read_table

EOS, PAD = 0, -1

# ----------------------------------------------------------------------------- F: token arrays


@register(
    "f3_left_truncate",
    f"""WITH {IDS_SQL}
SELECT vec_id, array_to_string(list_slice(prompt_ids, greatest(len(prompt_ids) - 8, 0) + 1, len(prompt_ids)), ',') AS kept,
       CAST(least(len(prompt_ids), 8) AS INTEGER) AS n_kept FROM ids""",
)
def f3_left_truncate(spark, sf):
    t = TK.left_truncate("prompt_ids", 8)
    return ids(spark, sf).select("vec_id", F.array_join(t, ",").alias("kept"), F.size(t).alias("n_kept"))


_MASK_SQL = "CASE WHEN coalesce(list_position(completion_ids, 0), 0) = 0 THEN len(completion_ids) ELSE list_position(completion_ids, 0) END"
_TERM_SQL = "list_contains(completion_ids, 0)"


@register("f4_eos_mask", f"WITH {IDS_SQL}\nSELECT vec_id, CAST({_MASK_SQL} AS INTEGER) AS mask_len FROM ids")
def f4_eos_mask(spark, sf):
    return ids(spark, sf).select("vec_id", TK.eos_mask_length("completion_ids", EOS).alias("mask_len"))


@register("f5_terminated", f"WITH {IDS_SQL}\nSELECT vec_id, {_TERM_SQL} AS terminated FROM ids")
def f5_terminated(spark, sf):
    return ids(spark, sf).select("vec_id", TK.terminated("completion_ids", EOS).alias("terminated"))


@register(
    "f6_mask_truncated",
    f"WITH {IDS_SQL}\nSELECT vec_id, CAST(CASE WHEN {_TERM_SQL} THEN {_MASK_SQL} ELSE 0 END AS INTEGER) AS mask_len FROM ids",
)
def f6_mask_truncated(spark, sf):
    return ids(spark, sf).select(
        "vec_id", TK.masked_length("completion_ids", EOS, mask_truncated=True).alias("mask_len")
    )


@register(
    "f7_concat_tokens",
    f"""WITH {IDS_SQL}
SELECT vec_id, CAST(len(prompt_ids) + len(completion_ids) AS INTEGER) AS n_tokens,
       CAST(len(prompt_ids) + {_MASK_SQL} AS INTEGER) AS n_attended,
       array_to_string(list_concat(prompt_ids, completion_ids), ',') AS joined FROM ids""",
)
def f7_concat_tokens(spark, sf):
    d = ids(spark, sf)
    both = TK.concat_tokens("prompt_ids", "completion_ids")
    return d.select(
        "vec_id",
        F.size(both).alias("n_tokens"),
        (F.size("prompt_ids") + TK.eos_mask_length("completion_ids", EOS)).alias("n_attended"),
        F.array_join(both, ",").alias("joined"),
    )


@register(
    "f8_pad_export",
    f"""WITH {IDS_SQL},
m AS (SELECT vec_id, vec_id // 16 AS batch, prompt_ids, list_slice(completion_ids, 1, {_MASK_SQL}) AS comp FROM ids),
w AS (SELECT *, max(len(prompt_ids)) OVER (PARTITION BY batch) AS lp, max(len(comp)) OVER (PARTITION BY batch) AS lc FROM m)
SELECT vec_id, batch,
       array_to_string(list_reverse(list_resize(list_reverse(prompt_ids), lp, -1)), ',') AS prompt_padded,
       array_to_string(list_resize(comp, lc, -1), ',') AS completion_padded
FROM w""",
)
def f8_pad_export(spark, sf):
    d = ids(spark, sf).select(
        "vec_id",
        F.floor(F.col("vec_id") / 16).cast("bigint").alias("batch"),
        "prompt_ids",
        F.slice("completion_ids", 1, TK.eos_mask_length("completion_ids", EOS)).alias("comp"),
    )
    out = TK.rectangular_export(d, "batch", prompt="prompt_ids", completion="comp", pad_id=PAD)
    return out.select(
        "vec_id",
        "batch",
        F.array_join("prompt_ids_padded", ",").alias("prompt_padded"),
        F.array_join("comp_padded", ",").alias("completion_padded"),
    )


# ----------------------------------------------------------------------------- L: loss analytics

CFG = L.LossConfig(epsilon=0.2, beta=0.04, loss_type="grpo", max_completion_length=64, off_policy_coef=1.0)


def _sums(spark, sf, cfg=CFG):
    return L.token_sums(tok(spark, sf), cfg)


_ROWSUM_SQL = f"""WITH {TOK_SQL},
toks AS (SELECT *, now_[i] AS a, old_[i] AS b, ref_[i] AS r FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM tok)),
tk AS (SELECT *, exp(a - b) AS ratio FROM toks),
tk2 AS (SELECT *, least(greatest(ratio, 0.8), 1.2) AS clip,
               -least(ratio * adv, least(greatest(ratio, 0.8), 1.2) * adv) AS tl,
               (ratio < 0.8 AND adv < 0) AS lo, (ratio > 1.2 AND adv > 0) AS hi,
               exp(r - a) - (r - a) - 1 AS kl FROM tk),
rowsum AS (
  SELECT vec_id, batch, is_online, adv, count(*) AS tok_n, sum(tl) AS loss_sum, sum(ratio) AS ratio_sum,
         sum(clip) AS clip_sum, sum(kl) AS kl_sum, count(*) FILTER (WHERE lo) AS n_low,
         count(*) FILTER (WHERE hi) AS n_high, count(*) FILTER (WHERE lo OR hi) AS n_region
  FROM tk2 GROUP BY ALL)"""


def _on(x: str, online: int) -> str:
    return f"coalesce(sum({x}) FILTER (WHERE is_online = {online}), 0)"


_BATCH_SQL = f"""{_ROWSUM_SQL},
b AS (
  SELECT batch, count(*) AS rows_, {_on('tok_n', 1)} AS on_tok, {_on('tok_n', 0)} AS off_tok, sum(tok_n) AS all_tok,
         {_on('loss_sum / greatest(tok_n, 1)', 1)} AS on_seq, {_on('loss_sum / greatest(tok_n, 1)', 0)} AS off_seq,
         {_on('loss_sum', 1)} AS on_ls, {_on('loss_sum', 0)} AS off_ls, {_on('kl_sum', 1)} AS on_kl,
         sum(n_low) AS low, {_on('n_low', 1)} AS on_low, {_on('n_low', 0)} AS off_low,
         sum(n_high) AS high, {_on('n_high', 1)} AS on_high, {_on('n_high', 0)} AS off_high,
         sum(n_region) AS region, {_on('n_region', 1)} AS on_region, {_on('n_region', 0)} AS off_region
  FROM rowsum GROUP BY batch)"""


def _flavour_sql(loss_type: str, max_len: int = 64) -> tuple[str, str]:
    if loss_type == "grpo":
        return "on_seq / rows_", "CASE WHEN off_tok > 0 THEN off_seq / rows_ ELSE 0.0 END"
    if loss_type == "bnpo":
        return "on_ls / greatest(on_tok, 1)", "CASE WHEN off_tok > 0 THEN off_ls / greatest(off_tok, 1) ELSE 0.0 END"
    return f"on_ls / (rows_ * {max_len})", f"CASE WHEN off_tok > 0 THEN off_ls / (rows_ * {max_len}) ELSE 0.0 END"


@register(
    "l1_ratio_clip",
    f"{_ROWSUM_SQL}\nSELECT vec_id, tok_n, round(ratio_sum, 6) AS ratio_sum, round(clip_sum, 6) AS clip_sum FROM rowsum",
)
def l1_ratio_clip(spark, sf):
    s = _sums(spark, sf)
    return s.select("vec_id", "tok_n", F.round("ratio_sum", 6).alias("ratio_sum"), F.round("clip_sum", 6).alias("clip_sum"))


@register("l2_token_loss", f"{_ROWSUM_SQL}\nSELECT vec_id, round(loss_sum, 6) AS loss_sum FROM rowsum")
def l2_token_loss(spark, sf):
    return _sums(spark, sf).select("vec_id", F.round("loss_sum", 6).alias("loss_sum"))


def _flavour_query(loss_type: str):
    cfg = L.LossConfig(epsilon=0.2, beta=0.04, loss_type=loss_type, max_completion_length=64)

    def q(spark, sf):
        out = L.batch_losses(_sums(spark, sf, cfg), cfg)
        return out.select("batch", F.round("on_loss", 6).alias("on_loss"), F.round("off_loss", 6).alias("off_loss"))

    on, off = _flavour_sql(loss_type)
    return q, f"{_BATCH_SQL}\nSELECT batch, round({on}, 6) AS on_loss, round({off}, 6) AS off_loss FROM b"


for _name, _lt in {"l3_grpo_loss": "grpo", "l3b_bnpo_loss": "bnpo", "l3c_dr_grpo_loss": "dr_grpo"}.items():
    _q, _sql = _flavour_query(_lt)
    register(_name, _sql)(_q)


@register("l4_kl", f"{_BATCH_SQL}\nSELECT batch, round(on_kl / greatest(on_tok, 1), 6) AS kl FROM b")
def l4_kl(spark, sf):
    return L.batch_losses(_sums(spark, sf), CFG).select("batch", F.round("kl", 6).alias("kl"))


_ON, _OFF = _flavour_sql("grpo")


@register(
    "l5_total_loss",
    f"{_BATCH_SQL}\nSELECT batch, round({_ON} + 0.04 * (on_kl / greatest(on_tok, 1)) + 1.0 * ({_OFF}), 6) AS loss FROM b",
)
def l5_total_loss(spark, sf):
    return L.batch_losses(_sums(spark, sf), CFG).select("batch", F.round("loss", 6).alias("loss"))


def _frac_sql() -> list[tuple[str, str]]:
    out = []
    for k in ("low", "high", "region"):
        out += [
            (f"clip_overall_{k}", f"{k} / greatest(all_tok, 1)"),
            (f"clip_on_{k}", f"on_{k} / greatest(on_tok, 1)"),
            (f"clip_off_{k}", f"CASE WHEN off_tok > 0 THEN off_{k} / greatest(off_tok, 1) ELSE 0.0 END"),
        ]
    return out


@register(
    "l6_clip_fractions",
    f"{_BATCH_SQL}\nSELECT batch, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in _frac_sql()) + " FROM b",
)
def l6_clip_fractions(spark, sf):
    out = L.batch_losses(_sums(spark, sf), CFG)
    return out.select("batch", *[F.round(n, 6).alias(n) for n, _ in _frac_sql()])


_L7_ITEMS = [("loss/on_policy", f"{_ON} + 0.04 * (on_kl / greatest(on_tok, 1))"), ("loss/off_policy", _OFF), ("kl", "on_kl / greatest(on_tok, 1)")] + [
    (L.METRIC_NAMES[n], e) for n, e in _frac_sql()
]


@register(
    "l7_loss_metrics",
    f"{_BATCH_SQL}\n" + "\nUNION ALL\n".join(f"SELECT batch, '{m}' AS metric, round({e}, 6) AS value FROM b" for m, e in _L7_ITEMS),
)
def l7_loss_metrics(spark, sf):
    m = L.loss_metrics(L.batch_losses(_sums(spark, sf), CFG), CFG)
    return m.select("batch", "metric", F.round("value", 6).alias("value"))


# ----------------------------------------------------------------------------- one step, end to end

_JOB_SQL = ",\n".join(
    [
        f"WITH {ROLL_SQL}",
        "moded AS (SELECT * REPLACE (CASE WHEN prompt_key % 5 = 0 THEN 'eval' ELSE 'train' END AS mode) FROM roll)",
        _pos_sql().replace("FROM roll", "FROM moded"),
        _req_sql(16),
        _buf_sql(16, 16),
        _choose_sql("highest_k", 8),
        f"""rowz AS (
  SELECT prompt_key, step AS batch_step, block AS batch_block, mode, 1 AS is_online, rollout_id, r_accuracy, r_format FROM moded
  UNION ALL SELECT {', '.join('c.' + x for x in GRP.split(', '))}, 'train', 0, c.rollout_id, m.r_accuracy, m.r_format
  FROM chosen c JOIN moded m USING (rollout_id)),
rew AS (SELECT *, coalesce(r_accuracy, 0) + coalesce(r_format, 0) AS reward FROM rowz),
advs AS (SELECT *, (reward - avg(reward) OVER w) / (coalesce(stddev_samp(reward) OVER w, 0) + 1e-4) AS adv
  FROM rew WINDOW w AS (PARTITION BY mode, {GRP}, is_online)),
em AS (SELECT vec_id, list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))) AS m,
  list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 50) AS INTEGER)) AS t FROM embeddings),
masked AS (SELECT *, CASE WHEN coalesce(list_position(t, 0), 0) = 0 THEN len(t) ELSE list_position(t, 0) END AS n FROM em),
tk AS (SELECT mode, batch_step, prompt_key, batch_block, is_online, rollout_id, adv, n, unnest(m[1:n]) AS x
  FROM advs JOIN masked ON vec_id = rollout_id % (SELECT count(*) FROM embeddings)),
tk1 AS (SELECT *, exp(-1.1 * x + x) AS ratio, exp(0.2 * x) - 0.2 * x - 1 AS kl FROM tk),
tk2 AS (SELECT *, -least(ratio * adv, least(greatest(ratio, 0.8), 1.2) * adv) AS tl, (ratio < 0.8 AND adv < 0) AS lo,
  (ratio > 1.2 AND adv > 0) AS hi FROM tk1),
rs AS (SELECT mode, batch_step, prompt_key, batch_block, is_online, rollout_id, count(*) AS tok_n, sum(tl) AS loss_sum, sum(kl) AS kl_sum,
  count(*) FILTER (WHERE lo) AS n_low, count(*) FILTER (WHERE hi) AS n_high, count(*) FILTER (WHERE lo OR hi) AS n_region FROM tk2 GROUP BY ALL)""",
        _BATCH_SQL[_BATCH_SQL.rindex("b AS (") :].replace("SELECT batch,", "SELECT mode, batch_step AS step,").replace("FROM rowsum GROUP BY batch", "FROM rs GROUP BY mode, batch_step"),
    ]
)


@register(
    "job_replay_to_loss",
    f"{_JOB_SQL}\n" + "\nUNION ALL\n".join(f"SELECT mode, step, '{m}' AS metric, round({e}, 6) AS value FROM b" for m, e in _L7_ITEMS),
)
def job_replay_to_loss(spark, sf):
    """Log -> replay -> token fetch -> masks -> advantages -> losses -> metrics, eval steps kept apart."""
    log = roll(spark, sf).withColumn("mode", F.when(F.col("prompt_key") % 5 == 0, "eval").otherwise("train"))
    emb = read_table(spark, sf, "embeddings")
    size = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    by_vec = emb.select("vec_id", size.alias("m")).select(
        "vec_id",
        F.transform("m", lambda x: F.floor(x * 50).cast("int")).alias("completion_ids"),
        F.transform("m", lambda x: -1.1 * x).alias("logps"),
        F.transform("m", lambda x: -x).alias("old_logps"),
        F.transform("m", lambda x: -0.9 * x).alias("ref_logps"),
    )
    n = emb.select(F.count(F.lit(1))).scalar()
    tokens = log.select("rollout_id", (F.col("rollout_id") % n).alias("vec_id")).join(by_vec, "vec_id").drop("vec_id")
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    _, metrics = jobs.replay_to_loss(log, tokens, cfg, CFG, eos=EOS, position="fifo", prompt_length="prompt_len")
    names = [m for m, _ in _L7_ITEMS]
    return metrics.filter(F.col("metric").isin(names)).select("mode", "step", "metric", F.round("value", 6).alias("value"))
