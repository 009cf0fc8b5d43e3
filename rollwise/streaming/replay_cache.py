"""Structured Streaming forms of the rollout log (ST1-ST4).

ST1 keeps the per-prompt FIFO as keyed state (``applyInPandasWithState``). A block reads the
buffer as it was before its step, so its replays are emitted as soon as its first row
arrives: no group size is needed, late blocks and short steps are answered too, and a step's
rows are pushed when a later step begins. State per prompt is two buffers of at most C rows
(before the open step, and the newest of the open step) and the open step's block numbers.
A prompt's steps arrive one after the other, as its trainer writes them.

A state call costs a millisecond or two before it sees a row, so prompts are dealt to ``BUCKETS`` hash
buckets and a call handles the prompts of a bucket together, in arrays: laid out one after the other, each
as its two buffers and its new rows, a prompt's rows have every buffer that is read as a slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rollwise.operators.replay import ReplayConfig

#: Groups that prompts are dealt to by hash. Fixed for the life of a checkpoint; a bucket's state is some
#: 1 KB a prompt at C = 16, and no more than so many tasks have rows.
BUCKETS = 4096
#: buffer rows picked from at once
PICKED_AT_ONCE = 1 << 18

#: A prompt's head: its NULL flag, open step, rows before the open step and of it, and answered blocks.
HEAD = np.dtype([("null", "?"), ("step", "<i8"), ("n_buf", "<i8"), ("n_open", "<i8"), ("n_blocks", "<i8")])
ROW = np.dtype([("rollout_id", "<i8"), ("seq", "<i8"), ("score", "<f8")])
BLOCK = np.dtype("<i4")
STATE_SCHEMA = "buckets int, tokens array<{}>, heads binary, rows binary, blocks binary"


def _ordered(*keys: np.ndarray) -> np.ndarray:
    """Column positions of each line sorted by the keys, the first one first; ties keep their order."""
    return np.lexsort(keys[::-1], axis=-1)


def _random_order(cfg: ReplayConfig, step: np.ndarray, block: np.ndarray, ids: np.ndarray, there: np.ndarray, seq: np.ndarray) -> np.ndarray:
    digests = np.zeros((*ids.shape, 2), dtype=">u8")
    for i, (s, b) in enumerate(zip(step.tolist(), block.tolist(), strict=True)):
        start = f"{cfg.seed}:{s}:{b}:"
        own = b"".join(hashlib.md5(f"{start}{x}".encode()).digest() for x in ids[i, there[i]].tolist())
        digests[i, there[i]] = np.frombuffer(own, dtype=">u8").reshape(-1, 2)
    return _ordered(~there, digests[..., 0].astype("u8"), digests[..., 1].astype("u8"), seq)


def _max_variance(score: np.ndarray, seq: np.ndarray, there: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Same rule as the batch closed form: i lowest + (k-i) highest of the scored rows,
    best by (k*sum(y^2) - sum(y)^2, sum, -i) for y the distance from the middle score; equal
    scores earliest first; unscored fill. Returns column positions, the chosen ones first and by seq."""
    lines, width = np.arange(len(score))[:, None], score.shape[1]
    at = np.arange(width)
    scored = there & ~np.isnan(score)
    m = scored.sum(axis=1)
    kk = np.minimum(k, m)
    by_score = _ordered(~scored, np.where(scored, score, 0.0), seq)
    xs = np.take_along_axis(score, by_score, axis=1)
    mid = np.take_along_axis(xs, np.minimum(m // 2, width - 1)[:, None], axis=1)
    y = np.where(at < m[:, None], xs - mid, 0.0)
    # Sums of the i lowest, then the others are added one by one: a sum has its terms in the order of the scores.
    most = int(kk.max(initial=0))
    i = np.arange(most + 1)
    low = lambda v: np.concatenate([np.zeros((len(v), 1)), np.cumsum(v, axis=1)], axis=1)[:, : most + 1]
    s1, s2 = low(y), low(y * y)
    for t in range(most):
        j = np.minimum((m - kk)[:, None] + i + t, width - 1)
        term = np.where(i + t < kk[:, None], y[lines, j], 0.0)
        s1, s2 = s1 + term, s2 + term * term
    value = kk[:, None] * s2 - s1 * s1
    best, best_v, best_s = np.zeros(len(score), dtype=int), value[:, 0], s1[:, 0]
    for c in range(1, most + 1):
        better = (c <= kk) & ((value[:, c] > best_v) | ((value[:, c] == best_v) & (s1[:, c] > best_s)))
        best, best_v, best_s = np.where(better, c, best), np.where(better, value[:, c], best_v), np.where(better, s1[:, c], best_s)
    picked = (at < m[:, None]) & ((at < best[:, None]) | (at >= (m - kk + best)[:, None]))
    # Of equal scores as many as were picked, from the first on.
    first = np.ones(xs.shape, dtype=bool)
    first[:, 1:] = xs[:, 1:] != xs[:, :-1]
    start = np.maximum.accumulate(np.where(first, at, 0), axis=1)
    last = np.append(first[:, 1:], np.ones((len(xs), 1), dtype=bool), axis=1)
    end = np.minimum.accumulate(np.where(last, at, width)[:, ::-1], axis=1)[:, ::-1]
    upto = np.concatenate([np.zeros((len(xs), 1), dtype=int), np.cumsum(picked, axis=1)], axis=1)
    taken = np.zeros(score.shape, dtype=bool)
    taken[lines, by_score] = (at < m[:, None]) & (at - start < upto[lines, end + 1] - upto[lines, start])
    others = there & ~scored
    by_age = _ordered(~others, seq)
    fills = np.zeros(score.shape, dtype=bool)
    fills[lines, by_age] = at < (k - kk)[:, None]
    return _ordered(~(taken | (fills & others)), seq, ~scored)


def _pick(cfg: ReplayConfig, rows: np.ndarray, step: np.ndarray, block: np.ndarray, lo: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """The ids to replay for each of the buffers ``rows[lo : lo + n]`` (oldest first), in listing order."""
    at = np.arange(int(n.max(initial=0)))
    there = at < n[:, None]
    where = np.where(there, lo[:, None] + at, lo[:, None])
    k = n if cfg.strategy == "all" else np.minimum(n, cfg.num_replays)
    score, seq = rows["score"][where], rows["seq"][where]
    if cfg.strategy == "all":
        order = np.broadcast_to(at, where.shape)
    elif cfg.strategy == "recent_k":
        order = np.minimum((n - k)[:, None] + at, len(at) - 1)
    elif cfg.strategy == "highest_k":
        unscored = np.isnan(score)
        order = _ordered(~there, unscored, np.where(unscored, 0.0, -score), seq)
    elif cfg.strategy == "random_k":
        order = _random_order(cfg, step, block, rows["rollout_id"][where], there, seq)
    elif cfg.strategy == "max_variance_k":
        order = _max_variance(score, seq, there, k)
    else:
        raise ValueError(cfg.strategy)
    buffer, slot = np.nonzero(at < k[:, None])
    return np.split(rows["rollout_id"][where[buffer, order[buffer, slot]]], np.cumsum(k)[:-1])


def replay_state_fn(cfg: ReplayConfig, buckets: int = BUCKETS) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The state function of a bucket for ``applyInPandasWithState``."""
    cfg.validate()
    c = cfg.max_cache

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(pdfs), ignore_index=True)
        if any(new[x].dtype.kind != "i" for x in ("rollout_id", "seq", "step", "block")):
            raise ValueError("NULL in rollout_id, seq, step or block")
        tokens, heads, held, blocks = [], np.empty(0, HEAD), np.empty(0, ROW), np.empty(0, BLOCK)
        if state.exists:
            made_for, tokens, *packed = state.get
            if made_for != buckets:
                raise ValueError(f"the checkpoint was begun with {made_for} buckets, not {buckets}")
            heads, held, blocks = (np.frombuffer(bytes(x), kind) for x, kind in zip(packed, (HEAD, ROW, BLOCK), strict=True))
        # Prompts are numbered; NULL is one that no token has.
        every = np.concatenate([np.array(tokens, dtype=new["token"].dtype), new["token"].to_numpy()])
        null = np.concatenate([heads["null"], new["null"].to_numpy(dtype=bool)])
        prompt = pd.factorize(every)[0]
        prompt[null] = len(every)
        _, shown, prompt = np.unique(prompt, return_index=True, return_inverse=True)
        known, prompt = prompt[: len(heads)], prompt[len(heads) :]
        n_prompts = len(shown)

        def per_prompt(name: str) -> np.ndarray:
            out = np.zeros(n_prompts, dtype="i8")
            out[known] = heads[name]
            return out

        n_buf, n_open, step = per_prompt("n_buf"), per_prompt("n_open"), per_prompt("step")
        # The rows of a prompt: its two buffers as they are, then its new rows by seq.
        fresh = np.lexsort((new["seq"].to_numpy(), prompt))
        prompt, steps, asked = prompt[fresh], new["step"].to_numpy()[fresh], new["block"].to_numpy()[fresh].astype(BLOCK)
        added = np.empty(len(new), ROW)
        for x in ROW.names:
            added[x] = new[x].to_numpy(dtype=ROW[x])[fresh]
        owner = np.concatenate([np.repeat(known, heads["n_buf"] + heads["n_open"]), prompt])
        laid = np.argsort(owner, kind="stable")
        rows, owner = np.concatenate([held, added])[laid], owner[laid]
        end = np.searchsorted(owner, np.arange(n_prompts), side="right")
        begin = np.append(0, end[:-1])
        count = np.bincount(prompt, minlength=n_prompts)
        place = np.arange(len(new)) + (begin + n_buf + n_open - (np.cumsum(count) - count))[prompt]

        # Runs of rows of one step; a prompt's first one may go on with its open step.
        head = np.ones(len(new), dtype=bool)
        head[1:] = (prompt[1:] != prompt[:-1]) | (steps[1:] != steps[:-1])
        run, first = np.cumsum(head) - 1, np.flatnonzero(head)
        r_prompt, r_step = prompt[first], steps[first]
        is_first = np.append(True, r_prompt[1:] != r_prompt[:-1])
        goes_on = is_first & (n_open[r_prompt] > 0) & (r_step == step[r_prompt])
        p0 = place[first] - np.where(goes_on, n_open[r_prompt], 0)

        # The blocks of a run in the order they come, without those that were answered before.
        pair = lambda who, b: who.astype("i8") << 32 | b.astype("u4")
        ask = np.sort(np.unique(pair(run, asked), return_index=True)[1])
        b_owner = np.repeat(known, heads["n_blocks"])
        seen = np.isin(pair(prompt[ask], asked[ask]), pair(b_owner, blocks))
        ask = ask[~(goes_on[run[ask]] & seen)]

        size = p0 - np.maximum(p0 - c, begin[r_prompt])
        reads = ask[(size[run[ask]] >= max(cfg.min_cache, 1)) & (cfg.strategy != "none")]
        out_token, out_null = every[shown], null[shown]

        # The next state: the open step is the one of a prompt's last run.
        last = np.append(r_prompt[1:] != r_prompt[:-1], True)
        opened = begin + n_buf
        opened[r_prompt[last]], step[r_prompt[last]] = p0[last], r_step[last]
        stays = np.ones(n_prompts, dtype=bool)
        stays[r_prompt[last]] = goes_on[last]
        at, since, upto = np.arange(len(rows)), opened[owner], end[owner]
        buf, open_ = (at < since) & (at >= since - c), (at >= since) & (at >= upto - c)
        late = ask[last[run[ask]]]
        b_owner, blocks = np.concatenate([b_owner[stays[b_owner]], prompt[late]]), np.concatenate([blocks[stays[b_owner]], asked[late]])
        after = np.empty(n_prompts, HEAD)
        after["null"], after["step"] = out_null, step
        for x, who in (("n_buf", owner[buf]), ("n_open", owner[open_]), ("n_blocks", b_owner)):
            after[x] = np.bincount(who, minlength=n_prompts)
        listed = blocks[np.argsort(b_owner, kind="stable")].astype(BLOCK)
        state.update((buckets, out_token.tolist(), after.tobytes(), rows[buf | open_].tobytes(), listed.tobytes()))

        each = max(1, PICKED_AT_ONCE // c)
        for some in (reads[i : i + each] for i in range(0, len(reads), each)):
            r = run[some]
            replays = _pick(cfg, rows, r_step[r], asked[some], p0[r] - size[r], size[r])
            who = r_prompt[r]
            yield pd.DataFrame({"token": out_token[who], "null": out_null[who], "batch_step": r_step[r], "batch_block": asked[some], "replays": replays})

    return fn


def route(stream: DataFrame, modes: tuple[str, ...] = ("train",)) -> DataFrame:
    """ST4: rows of the given modes (train only, by default) go to the cache."""
    return stream.filter(F.col("mode").isin(*modes))


def _token(key: Column, kind: T.DataType) -> Column:
    """A prompt key as a number or a string, as Python can compare them."""
    if isinstance(kind, T.IntegralType):
        return F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(F.hex(key) if isinstance(kind, T.BinaryType) else key.cast("string"), F.lit(""))


def streaming_replays(stream: DataFrame, cfg: ReplayConfig, *, score: str = "score", buckets: int = BUCKETS) -> DataFrame:
    """ST1: replay emissions from a rollout stream with ``prompt_key, rollout_id, seq, step, block, score``.

    The prompt key, a plain value, keeps the type it has in the stream. A stream is run on with the ``buckets`` it was begun with.
    """
    src = route(stream, cfg.modes) if cfg.modes else stream
    kind = src.schema["prompt_key"].dataType
    key = F.col("prompt_key")
    cols = src.select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
        _token(key, kind).alias("token"), key.isNull().alias("null"),
        *[F.col(x).cast("bigint").alias(x) for x in ("rollout_id", "seq", "step")],
        F.col("block").cast("int").alias("block"), F.col(score).cast("double").alias("score"),
    )
    token_type = cols.schema["token"].dataType.simpleString()
    # A row for each block: Python hands over fewer rows, and the ids are at most C.
    output = f"token {token_type}, null boolean, batch_step long, batch_block int, replays array<long>"
    replays = cols.groupBy("bucket").applyInPandasWithState(
        replay_state_fn(cfg, buckets), output, STATE_SCHEMA.format(token_type), "append", GroupStateTimeout.NoTimeout
    )
    back = F.unhex("token") if isinstance(kind, T.BinaryType) else F.col("token").cast(kind)
    listed = replays.select(F.when(~F.col("null"), back).alias("prompt_key"), "batch_step", "batch_block", F.posexplode("replays").alias("replay_slot", "rollout_id"))
    return listed.withColumn("replay_slot", F.col("replay_slot").cast("bigint"))


def step_metrics_stream(stream: DataFrame, reward: str = "reward", length: str = "completion_len") -> DataFrame:
    """ST3: per (mode, step) running aggregates of the online stream (update/complete mode)."""
    return stream.groupBy("mode", "step").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(reward).alias("reward_sum"),
        F.avg(reward).alias("reward_mean"),
        F.sum(length).alias("tokens"),
    )
