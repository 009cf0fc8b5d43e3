"""Streaming replay as keyed state: buckets of prompts give what prompts one by one give, wherever triggers cut."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollwise.functions.rewards import plain_score
from rollwise.operators.replay import ReplayConfig
from rollwise.plans import q_streaming
from rollwise.plans.fixtures import REWARDS, roll
from rollwise.streaming import replay_cache as RC
from rollwise.streaming import runner
from tests.conftest import SF_SMALL
from tests.test_replay_tables import batch, listed, make_log, parts


class State:
    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def make_rows(seed, n=700, prompts=9):
    """Steps of 1 to 12 rows in up to three blocks, tied and missing scores; prompt None among them."""
    rng, out, at = np.random.default_rng(seed), [], {}
    for seq in range(n):
        p = int(rng.integers(0, prompts)) or None
        step, left = at.get(p, (-1, 0))
        at[p] = (step, left - 1) if left else (step + int(rng.integers(1, 3)), int(rng.integers(0, 12)))
        score = None if rng.random() < 0.2 else float(rng.choice([-1.5, 0.0, 0.1, 0.7, 2.0]))
        out.append((p, 10_000 + seq, seq, at[p][0], int(rng.integers(0, 3)), score))
    return out


def brute_pick(cfg, buf, step, block):
    """Ids of ``buf``, rows (id, seq, score), by the rule of the strategy."""
    k = len(buf) if cfg.strategy == "all" else min(len(buf), cfg.num_replays)
    if cfg.strategy in ("all", "recent_k"):
        return [x[0] for x in buf[len(buf) - k :]]
    if cfg.strategy == "highest_k":
        return [x[0] for x in sorted(buf, key=lambda x: (x[2] is None, -(x[2] or 0), x[1]))[:k]]
    if cfg.strategy == "random_k":
        return [x[0] for x in sorted(buf, key=lambda x: hashlib.md5(f"{cfg.seed}:{step}:{block}:{x[0]}".encode()).hexdigest())[:k]]
    scored, others = sorted((x for x in buf if x[2] is not None), key=lambda x: (x[2], x[1])), [x for x in buf if x[2] is None]
    m, kk = len(scored), min(k, sum(x[2] is not None for x in buf))
    best = None
    for i in range(kk + 1):
        pick = scored[:i] + scored[m - (kk - i) :]
        y = [np.float64(x[2] - scored[m // 2][2]) for x in pick] if m else []  # summed plainly, term by term
        cand = (kk * sum(v * v for v in y) - sum(y) ** 2, sum(y), -i)
        if best is None or cand > best[0]:
            best = (cand, sorted(x[2] for x in pick))
    chosen = [x for v in set(best[1]) for x in [r for r in scored if r[2] == v][: best[1].count(v)]]
    return [x[0] for x in sorted(chosen + others[: k - kk], key=lambda x: x[1])]


def one_by_one(cfg, rows):
    """Every prompt's FIFO kept by hand, over the whole log."""
    fifo, open_step, before, answered, out = {}, {}, {}, {}, []
    for p, rid, seq, step, block, score in rows:
        if open_step.get(p) != step:
            open_step[p], before[p], answered[p] = step, list(fifo.get(p, [])), set()
        if block not in answered[p]:
            answered[p].add(block)
            if len(before[p]) >= cfg.min_cache and cfg.strategy != "none":
                out += [(p, step, block, slot, x) for slot, x in enumerate(brute_pick(cfg, before[p], step, block))]
        fifo[p] = [*fifo.get(p, []), (rid, seq, score)][-cfg.max_cache :]
    return sorted(out, key=str)


def in_buckets(cfg, rows, cuts, string=False):
    """The state function over triggers: all prompts in one bucket, rows of a trigger in any order and in two frames."""
    fn, state, out = RC.replay_state_fn(cfg), State(), []
    token = (lambda p: "" if p is None else f"p{p}") if string else (lambda p: p or 0)
    edges = [0, *cuts, len(rows)]
    for a, b in zip(edges, edges[1:], strict=False):
        some = [rows[i] for i in np.random.default_rng(a).permutation(np.arange(a, b))]
        frame = pd.DataFrame(
            {"token": [token(x[0]) for x in some], "null": [x[0] is None for x in some], "rollout_id": [x[1] for x in some], "seq": [x[2] for x in some],
             "step": [x[3] for x in some], "block": np.array([x[4] for x in some], dtype="i4"), "score": [math.nan if x[5] is None else x[5] for x in some]}
        )
        half = len(frame) // 2
        for got in fn((0,), iter([frame[:half], frame[half:]] if half else [frame]), state):
            for r in got.itertuples():
                p = None if r.null else int(str(r.token).removeprefix("p"))
                out += [(p, r.batch_step, r.batch_block, slot, int(x)) for slot, x in enumerate(r.replays)]
    return sorted(out, key=str)


def check_strategy(strategy, monkeypatch, string=False):
    monkeypatch.setattr(RC, "PICKED_AT_ONCE", 40)  # several chunks of buffers a call
    for seed in range(12):
        for k, gate, cache in ((3, 4, 7), (8, 0, 5), (0, 1, 3), (1, 1, 1), (6, 16, 16)):
            cfg, rows = ReplayConfig(strategy=strategy, num_replays=k, min_cache=min(gate, cache), max_cache=cache), make_rows(seed)
            assert in_buckets(cfg, rows, [1, 2, 90, 350, 351, 600], string) == one_by_one(cfg, rows)


@pytest.mark.parametrize("strategy", ["none", "all", "recent_k", "highest_k"])
def test_a_bucket_is_its_prompts_one_by_one(strategy, monkeypatch):
    check_strategy(strategy, monkeypatch)


@pytest.mark.parametrize("strategy", ["all", "highest_k"])
def test_many_prompts_share_a_state(spark, strategy):
    """One state a bucket, not a prompt; equal to the batch replay with cuts inside steps and blocks, eval rows and NULL prompts."""
    cfg = ReplayConfig(strategy=strategy, num_replays=3, min_cache=4, max_cache=7)
    log, base = make_log(spark, 900).coalesce(1), runner.run_folder(spark, f"cache-{strategy}")
    for n, part in enumerate(parts(log, [1, 64, 215, 700])):
        part.write.parquet(f"{base}/source/{n}")
        stream = runner.file_stream(spark, f"{base}/source/*/*.parquet", log.schema, max_files=None)
        runner.append_to_parquet(RC.streaming_replays(stream, cfg, buckets=3), f"{base}/sink", f"{base}/checkpoint")
    assert listed(spark.read.parquet(f"{base}/sink")) == batch(log, cfg)
    assert spark.read.format("statestore").load(f"{base}/checkpoint").count() <= 3 < log.select("prompt_key").distinct().count()


def test_appends_in_many_files(spark):
    """A prompt's rows of one append lie in all of its files, which come in no order: a trigger reads them all."""
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    got = q_streaming._replay_stream_query("files", renumber=lambda log: log.repartition(12))(spark, SF_SMALL)
    assert listed(got) == batch(roll(spark, SF_SMALL).withColumn("score", plain_score(REWARDS)), cfg)


def test_a_checkpoint_keeps_its_buckets():
    state = State()
    frame = pd.DataFrame({"token": 1, "null": False, "rollout_id": range(30), "seq": range(30), "step": 0, "block": np.zeros(30, "i4"), "score": 0.0})
    assert not list(RC.replay_state_fn(ReplayConfig(), 8)((0,), iter([frame]), state))
    with pytest.raises(ValueError, match="8 buckets"):
        list(RC.replay_state_fn(ReplayConfig(), 16)((0,), iter([frame]), state))


def test_random_picks_of_a_bucket(monkeypatch):
    check_strategy("random_k", monkeypatch)


def test_max_variance_picks_of_a_bucket(monkeypatch):
    check_strategy("max_variance_k", monkeypatch)


def test_string_tokens(monkeypatch):
    check_strategy("highest_k", monkeypatch, string=True)


@pytest.mark.parametrize("kind", ["concat('p', k)", "CAST(CAST(k AS STRING) AS BINARY)", "k + 9007199254740993"])
def test_prompt_keys_of_any_type(spark, kind):
    """Each keeps its type and value, also beside NULL and beyond what a double holds."""
    cfg = ReplayConfig(strategy="all", min_cache=1, max_cache=2)
    log = spark.range(30).selectExpr("id AS rollout_id", "id AS seq", "id DIV 5 AS step", "CAST(0 AS INT) AS block", "1.0D AS score", "'train' AS mode", "CASE WHEN id % 5 > 0 THEN id % 5 END AS k")
    by_k = batch(log.withColumn("prompt_key", F.col("k")), cfg)
    log, base = log.selectExpr("*", f"{kind} AS prompt_key").coalesce(1), runner.run_folder(spark, "cache-keys")
    named = {r.k: r.prompt_key for r in log.select("k", "prompt_key").distinct().collect()}
    log.write.parquet(f"{base}/source/0")
    got = RC.streaming_replays(runner.file_stream(spark, f"{base}/source/*/*.parquet", log.schema), cfg)
    assert got.schema["prompt_key"].dataType == log.schema["prompt_key"].dataType
    runner.append_to_parquet(got, f"{base}/sink", f"{base}/checkpoint")
    assert listed(spark.read.parquet(f"{base}/sink")) == sorted(((named[r[0]], *r[1:]) for r in by_k), key=str)


def test_routed_appends_in_many_files(spark):
    """Eval prompts share buckets and files with the others: they neither ask nor are cached."""
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    got = q_streaming._replay_stream_query("routed", eval_every=5, renumber=lambda log: log.repartition(12))(spark, SF_SMALL)
    log = roll(spark, SF_SMALL).withColumn("score", plain_score(REWARDS)).filter("prompt_key % 5 <> 0")
    assert listed(got) == batch(log, cfg) != []


def test_two_blocks_in_many_files(spark):
    """Blocks of a step in several files and triggers read the same buffer."""
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    got = q_streaming._replay_stream_query("blocks", renumber=lambda log: q_streaming._two_blocks(log).repartition(12))(spark, SF_SMALL)
    assert listed(got) == batch(q_streaming._two_blocks(roll(spark, SF_SMALL).withColumn("score", plain_score(REWARDS))), cfg) != []
