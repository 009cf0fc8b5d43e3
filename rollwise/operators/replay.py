"""Replay over an append-only rollout log.

The per-prompt FIFO of the trainer is not kept as mutable state here. Every online
rollout gets its position ``pos`` in its prompt's append order; the buffer a step reads
is then the rows with ``pos`` in ``[p0 - C, p0 - 1]``, where ``p0`` is the prompt's first
position in that step (the cache is read before the step's own rows are pushed). That
range is found with an equi-join on ``(prompt, floor(pos / C))``, so no task ever holds
more than a few buffers' worth of one prompt, however hot the prompt is. Strategies then
rank inside ``(prompt, step, block)`` groups, which hold at most C rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.operators.positions import rank_within_key

STRATEGIES = ("none", "all", "random_k", "highest_k", "recent_k", "max_variance_k")


@dataclass(frozen=True)
class ReplayConfig:
    strategy: str = "highest_k"
    num_replays: int = 8
    min_cache: int = 16
    max_cache: int = 16
    seed: int = 42
    modes: tuple[str, ...] = ("train",)

    def validate(self) -> "ReplayConfig":
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown replay strategy {self.strategy!r}; expected one of {STRATEGIES}")
        if self.max_cache < 1:
            raise ValueError("max_cache must be at least 1")
        if self.min_cache > self.max_cache:
            raise ValueError(
                f"min_cache ({self.min_cache}) > max_cache ({self.max_cache}): the gate could never open"
            )
        if self.num_replays < 0:
            raise ValueError("num_replays must be >= 0")
        return self


#: marks positions counted here, which have no gaps
RANKED = "rollwise.ranked"


def with_positions(
    log: DataFrame,
    *,
    key: str = "prompt_key",
    seq: str = "seq",
    modes: tuple[str, ...] | None = ("train",),
    position: str | None = None,
    n_ranges: int | None = None,
) -> DataFrame:
    """Rows that enter the cache (``mode`` in ``modes``; None keeps all) with their ``pos``.

    ``pos`` is the row's append number within its prompt, ranked by ``seq`` (skew-safe, see
    positions.py): steps, visits and blocks play no part, so global step numbers, several
    blocks per step and short groups are all right. ``position`` names a column that already
    holds that number among the cached rows, and saves the ranking.
    """
    src = log.filter(F.col("mode").isin(*modes)) if modes else log
    if position:
        return src.withColumn("pos", F.col(position).cast("bigint"))
    ranked = rank_within_key(src, [key], seq, out="pos", n_ranges=n_ranges)
    return ranked.withMetadata("pos", {RANKED: True})


def fifo_state(log: DataFrame, cache_size: int, *, key: str = "prompt_key", seq: str = "seq") -> DataFrame:
    """The buffer after the whole log has been pushed: newest ``cache_size`` rows per prompt.

    Planned as WindowGroupLimit: each map task keeps at most ``cache_size`` rows per key
    before the shuffle, so a hot prompt ships only a bounded number of rows.
    """
    w = Window.partitionBy(key).orderBy(F.col(seq).desc())
    return (
        log.withColumn("_age", F.row_number().over(w))
        .filter(F.col("_age") <= cache_size)
        .withColumn("age", (F.col("_age") - 1).cast("bigint"))
        .drop("_age")
    )


def buffer_requests(
    pos_log: DataFrame, cache_size: int, *, key: str = "prompt_key", step: str = "step", block: str = "block"
) -> DataFrame:
    """One row per (prompt, step, block) of the batch: ``p0`` and the size of the buffer it reads.

    All blocks of a step read the buffer as it was before the step (the as-of boundary
    is the step, not the block), so ``p0`` is the minimum over the whole step. One
    aggregation per (prompt, step) also lists the step's blocks (a handful at most).
    """
    per_step = pos_log.groupBy(key, step).agg(
        F.min("pos").alias("p0"), F.collect_set(F.col(block)).alias("_blocks")
    )
    return per_step.select(
        key,
        F.col(step).alias("batch_step"),
        F.explode("_blocks").alias("batch_block"),
        "p0",
        F.least(F.col("p0"), F.lit(cache_size)).cast("bigint").alias("buf_size"),
    )


def gate(requests: DataFrame, min_cache: int) -> DataFrame:
    """keep requests whose buffer holds at least ``min_cache`` rows (positions without gaps: ``p0`` rows came before)."""
    return requests.filter(F.col("buf_size") >= F.lit(min_cache))


def buffer_asof(
    pos_log: DataFrame,
    requests: DataFrame,
    cache_size: int,
    *,
    key: str = "prompt_key",
    carry: tuple[str, ...] = ("rollout_id", "seq"),
) -> DataFrame:
    """For each request, the rows its buffer holds (``buf_idx`` 0 = oldest).

    A buffer spans positions ``[lo, p0 - 1]`` with ``lo = max(p0 - C, 0)``: at most two
    ranges of width C, so the request is exploded to those ranges and equi-joined.
    """
    c = F.lit(cache_size)
    lo = F.greatest(F.col("p0") - c, F.lit(0))
    req = (
        requests.filter(F.col("buf_size") > 0)
        .withColumn("buf_lo", lo)
        .withColumn(
            "_rng",
            F.explode(F.array_distinct(F.array(F.expr(f"buf_lo div {int(cache_size)}"), F.expr(f"(p0 - 1) div {int(cache_size)}")))),
        )
    )
    rows = pos_log.select(key, "pos", *carry).withColumn("_rng", F.expr(f"pos div {int(cache_size)}"))
    # Equality on the value and on being NULL is null-safe and hashes like a plain join key.
    named = {"_bk": F.coalesce(F.col(key), F.lit("" if dict(rows.dtypes)[key] == "string" else 0).cast(dict(rows.dtypes)[key])), "_bn": F.col(key).isNull()}
    return (
        req.withColumns(named)
        .join(rows.withColumns(named).drop(key), on=["_bk", "_bn", "_rng"], how="inner")
        .drop("_bk", "_bn")
        .filter((F.col("pos") >= F.col("buf_lo")) & (F.col("pos") < F.col("p0")))
        .withColumn("buf_idx", (F.col("pos") - F.col("buf_lo")).cast("bigint"))
        .drop("_rng", "buf_lo")
    )


GROUP = ("batch_step", "batch_block")


def counted_gate(buffer: DataFrame, min_cache: int, *, key: str = "prompt_key") -> DataFrame:
    """F9 on the rows that are there: ``buf_size`` becomes the counted size, smaller buffers go.

    Same groups as the strategies' windows, so it adds no shuffle; it holds where positions
    given by the caller have gaps.
    """
    counted = buffer.withColumn("buf_size", F.count(F.lit(1)).over(_group_window(key)))
    return counted.filter(F.col("buf_size") >= F.lit(min_cache))


def _group_window(key: str) -> Window:
    return Window.partitionBy(key, *GROUP)


def _k_eff(cfg: ReplayConfig) -> Column:
    if cfg.strategy == "all":
        return F.col("buf_size")
    return F.least(F.col("buf_size"), F.lit(cfg.num_replays))


def choose(buffer: DataFrame, cfg: ReplayConfig, *, key: str = "prompt_key", score: str = "score") -> DataFrame:
    """Pick the replayed rows of each request; ``replay_slot`` is their listing order.

    ``buffer`` is the output of :func:`buffer_asof` (gated) with a ``score`` column (G8).
    """
    cfg.validate()
    if cfg.strategy == "none":
        return buffer.limit(0).withColumn("replay_slot", F.lit(0).cast("bigint"))
    g = _group_window(key)
    k = _k_eff(cfg)
    b = buffer.withColumn("_k", k)
    if cfg.strategy == "all":
        out = b.withColumn("replay_slot", F.col("buf_idx"))
    elif cfg.strategy in ("random_k", "highest_k", "recent_k"):
        if cfg.strategy == "random_k":
            h = F.md5(F.concat_ws(":", F.lit(str(cfg.seed)), F.col("batch_step"), F.col("batch_block"), F.col("rollout_id")))
            order = [h, F.col("seq")]
        elif cfg.strategy == "highest_k":
            order = [F.col(score).desc_nulls_last(), F.col("seq")]
        else:
            order = [F.col("seq").desc()]
        # The literal bound lets the planner insert a partial WindowGroupLimit below the exchange:
        # each map task ships at most k rows per request instead of the whole buffer (unless the
        # rows had to be counted first, see counted_gate).
        out = b.withColumn("_r", F.row_number().over(g.orderBy(*order))).filter(F.col("_r") <= cfg.num_replays)
        out = out.filter(F.col("_r") <= F.col("_k"))
        slot = F.col("_k") - F.col("_r") if cfg.strategy == "recent_k" else F.col("_r") - 1
        out = out.withColumn("replay_slot", slot.cast("bigint"))
    elif cfg.strategy == "max_variance_k":
        out = _max_variance(b, key, score)
    else:  # pragma: no cover - validate() guards this
        raise ValueError(cfg.strategy)
    return out.drop("_k", "_r")


def _max_variance(b: DataFrame, key: str, score: str) -> DataFrame:
    """R7 in closed form, evaluated once per request.

    Among scored rows sorted ascending, an optimal size-k subset is the i lowest plus the
    k-i highest for some i in 0..k; compare ``k*sum(y^2) - sum(y)^2`` (exact for integer
    scores), y being the distance from the buffer's middle score so that scores far from zero
    lose no digits, then the larger sum, then the smaller i. Rows with equal scores are taken
    earliest-first, which is the first index set in enumeration order. When fewer than k
    rows are scored, every scored row is kept and the rest is filled with the earliest
    unscored rows.

    A request's buffer holds at most C rows, so it is gathered into one sorted array
    (unscored first by age, then scored by (score, age)), the choice is made with array
    functions, and the chosen rows are exploded back in age order.
    """
    grp = [key, *GROUP]
    carry = [c for c in b.columns if c not in (*grp, "_k", "seq", score)]
    entry = F.struct(
        F.col(score).isNotNull().alias("has"),
        F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("x"),
        F.col("seq").alias("seq"),
        *[F.col(c).alias(c) for c in carry],
    )
    per = b.groupBy(*grp).agg(F.array_sort(F.collect_list(entry)).alias("_it"), F.max("_k").alias("_kq"))
    scored = F.filter("_it", lambda e: e["has"])
    per = per.withColumn("_xs", F.transform(scored, lambda e: e["x"]))
    m = F.size("_xs")
    per = per.withColumn("_m", m).withColumn("_u", F.size("_it") - m)
    kk = F.least(F.col("_kq"), F.col("_m"))

    # Running sums of the sorted scores: a candidate's sums are two differences.
    def running(value):
        return F.aggregate(
            "_xs",
            F.array(F.lit(0.0)),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + value(x))),
        )

    per = per.withColumn("_mid", F.coalesce(F.get("_xs", F.expr("_m div 2").cast("int")), F.lit(0.0)))
    per = per.withColumns({"_s1": running(lambda x: x - F.col("_mid")), "_s2": running(lambda x: (x - F.col("_mid")) * (x - F.col("_mid")))})

    def cand(i):
        high = F.col("_m") - (kk - i)  # the k - i highest start here
        both = lambda s: F.get(s, i) + F.get(s, F.col("_m")) - F.get(s, high)
        s1, s2 = both(F.col("_s1")), both(F.col("_s2"))
        return F.struct((kk * s2 - s1 * s1).alias("v"), s1.alias("s"), (-i).alias("ni"))

    best_i = -F.array_max(F.transform(F.sequence(F.lit(0), kk), cand))["ni"]
    per = per.withColumn("_bi", F.when(kk > 0, best_i).otherwise(F.lit(0)))
    i, hi_n = F.col("_bi"), kk - F.col("_bi")
    per = per.withColumn(
        "_pick",
        F.when(kk > 0, F.concat(F.slice("_xs", 1, i), F.slice("_xs", F.col("_m") - hi_n + 1, hi_n))).otherwise(
            F.array().cast("array<double>")
        ),
    )

    def keep(e, j):
        # occurrence among equal scores: index minus the first index of that score
        occ = j + 1 - (F.col("_u") + F.array_position("_xs", e["x"])) + 1
        want = F.size(F.filter("_pick", lambda p: p == e["x"]))
        return F.when(e["has"], occ <= want).otherwise(j + 1 <= F.col("_kq") - F.col("_m"))

    kept = F.filter("_it", lambda e, j: keep(e, j))
    by_age = F.array_sort(F.transform(kept, lambda e: F.struct(e["seq"].alias("seq"), e.alias("e"))))
    out = per.select(*grp, F.posexplode(by_age).alias("replay_slot", "_r"))
    return out.select(
        *grp,
        F.col("replay_slot").cast("bigint").alias("replay_slot"),
        F.col("_r.seq").alias("seq"),
        F.when(F.col("_r.e.has"), F.col("_r.e.x")).alias(score),
        *[F.col(f"_r.e.{c}").alias(c) for c in carry],
    )


def replay_rows(
    pos_log: DataFrame,
    cfg: ReplayConfig,
    *,
    key: str = "prompt_key",
    score: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Gate + buffer + strategy: ``(prompt, batch_step, batch_block, replay_slot, rollout_id, seq)``.

    ``score`` is the G8 column evaluated on the log rows (defaults to the ``score`` column).
    ``carry`` names small per-row columns (rewards, lengths) to bring along with the chosen
    rows; wide payloads are better fetched afterwards by id (:func:`merge`).
    """
    cfg.validate()
    scored = pos_log.withColumn("score", score) if score is not None else pos_log
    req = gate(buffer_requests(scored, cfg.max_cache, key=key), cfg.min_cache)
    base = ("rollout_id", "seq", "score")
    extra = tuple(c for c in carry if c not in base)
    buf = buffer_asof(scored, req, cfg.max_cache, key=key, carry=base + extra)
    if not scored.schema["pos"].metadata.get(RANKED):  # positions of the caller may have gaps
        buf = counted_gate(buf, cfg.min_cache, key=key)
    return choose(buf, cfg, key=key).select(key, *GROUP, "replay_slot", *base, "buf_size", *extra)


def continue_positions(
    snapshot: DataFrame, new_rows: DataFrame, *, key: str = "prompt_key", seq: str = "seq", n_ranges: int | None = None
) -> DataFrame:
    """``new_rows`` with ``pos`` counted on from the newest row of each prompt's snapshot."""
    ranked = rank_within_key(new_rows, [key], seq, out="_new", n_ranges=n_ranges)
    newest = snapshot.groupBy(F.col(key).alias("_key")).agg((F.max("pos") + 1).alias("_from"))
    joined = ranked.join(newest, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn("pos", F.coalesce("_from", F.lit(0)) + F.col("_new")).drop("_key", "_from", "_new")


def replay_increment(
    snapshot: DataFrame,
    new_rows: DataFrame,
    cfg: ReplayConfig,
    *,
    key: str = "prompt_key",
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Replays for the steps in ``new_rows``, reading only the previous FIFO snapshot.

    ``snapshot`` holds each prompt's buffer after the earlier steps (at most C rows per
    prompt with their ``pos``, e.g. the previous call's second output); ``new_rows`` are the
    cached rows of the new steps with ``score``, numbered on from the snapshot. Returns the
    replays of the new steps and the next snapshot, so a growing log costs the new rows
    plus bounded state per run instead of its whole history.
    """
    cfg.validate()
    new_pos = continue_positions(snapshot, new_rows, key=key)
    cols = [key, "pos", "rollout_id", "seq", "score", *[c for c in carry if c not in ("rollout_id", "seq", "score")]]
    combined = snapshot.select(*cols).unionByName(new_pos.select(*cols))
    req = gate(buffer_requests(new_pos, cfg.max_cache, key=key), cfg.min_cache)
    base = ("rollout_id", "seq", "score")
    extra = tuple(c for c in cols[5:])
    buf = counted_gate(buffer_asof(combined, req, cfg.max_cache, key=key, carry=base + extra), cfg.min_cache, key=key)
    replays = choose(buf, cfg, key=key).select(key, *GROUP, "replay_slot", *base, "buf_size", *extra)
    next_snapshot = fifo_state(combined, cfg.max_cache, key=key, seq="pos").drop("age")
    return replays, next_snapshot


def merge_parts(
    online: DataFrame,
    replays: DataFrame,
    payload: DataFrame | None,
    *,
    key: str = "prompt_key",
    columns: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """The two sides of :func:`merge`, in the batch schema, before their union."""
    on = online.select(
        key,
        F.col("step").alias("batch_step"),
        F.col("block").alias("batch_block"),
        F.lit(1).alias("is_online"),
        F.col("slot").cast("bigint").alias("batch_slot"),
        "rollout_id",
        *columns,
    )
    if payload is not None:
        off = replays.select(key, *GROUP, "replay_slot", "rollout_id").join(
            payload.select("rollout_id", *columns), on="rollout_id", how="inner"
        )
    else:
        off = replays
    off = off.select(
        key,
        *GROUP,
        F.lit(0).alias("is_online"),
        F.col("replay_slot").alias("batch_slot"),
        "rollout_id",
        *columns,
    )
    return on, off


def merge(
    online: DataFrame,
    replays: DataFrame,
    payload: DataFrame | None,
    *,
    key: str = "prompt_key",
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """R8 (with J6): online rows tagged ``is_online=1``, replayed rows ``is_online=0``.

    Replayed rows keep the payload recorded when they were generated. With ``payload``
    given, it is fetched by joining the chosen ids back to the log, so wide columns never
    travel through the buffer join; with ``payload=None`` the columns were carried along
    by :func:`replay_rows`. ``batch_slot`` orders rows inside a block: online first, then replays.
    """
    on, off = merge_parts(online, replays, payload, key=key, columns=columns)
    return on.unionByName(off)


def replay_ledger(replays: DataFrame, *, key: str = "prompt_key") -> DataFrame:
    """Rows replayed and prompts reached per batch step."""
    return replays.groupBy("batch_step").agg(
        F.count(F.lit(1)).alias("replay_rows"), F.countDistinct(key).alias("prompts_replayed")
    )


def unmatched_replays(replays: DataFrame, batch: DataFrame, *, key: str = "prompt_key") -> DataFrame:
    """Replayed rows whose (prompt, step) has no online block in the batch; must be empty."""
    heads = batch.select(F.col(key).alias("_key"), F.col("step").alias("_step")).distinct()
    return replays.join(heads, F.col(key).eqNullSafe(F.col("_key")) & F.col("batch_step").eqNullSafe(F.col("_step")), "left_anti")


def cache_contents(state: DataFrame, columns: tuple[str, ...], *, key: str = "prompt_key", seq: str = "seq") -> DataFrame:
    """One row per prompt: ``contents``, its buffer's rows (at most C) in append order."""
    items = F.array_sort(F.collect_list(F.struct(F.col(seq), *[F.col(c) for c in columns])))
    return state.groupBy(key).agg(items.alias("contents"))


#: cache rows are compared by the digests of so many key ranges first
DIGEST_RANGES = 4096


def cache_digests(state: DataFrame, columns: tuple[str, ...], *, key: str = "prompt_key", seq: str = "seq") -> DataFrame:
    """(range, n, d1, d2): order-free digests of a cache state by key range, merged by adding."""
    row = [F.col(key), F.col(seq), *[F.col(c) for c in columns]]
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)"))
    return state.groupBy(_digest_range(key).alias("range")).agg(F.count(F.lit(1)).alias("n"), digest(1).alias("d1"), digest(2).alias("d2"))


def _digest_range(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(DIGEST_RANGES))


def cache_divergence(a: DataFrame, b: DataFrame, columns: tuple[str, ...], *, key: str = "prompt_key", seq: str = "seq") -> DataFrame:
    """Prompts whose buffers differ between two cache states, with both contents (NULL where a side has none).

    Key ranges whose digests agree are left out first (a map-side aggregate to DIGEST_RANGES rows
    a side), so equal caches are compared without moving their contents; the rows of the other
    ranges are compared as arrays, so NULL values and any characters count.
    """
    da, db = (cache_digests(x, columns, key=key, seq=seq) for x in (a, b))
    names = ["n", "d1", "d2"]
    both = da.select("range", F.struct(*names).alias("da")).join(db.select("range", F.struct(*names).alias("db")), "range", "full_outer")
    unlike = both.filter(~F.col("da").eqNullSafe(F.col("db"))).select(F.col("range").alias("_range"))

    def contents(state: DataFrame, name: str, side: str) -> DataFrame:
        # at most DIGEST_RANGES rows are broadcast
        rows = state.withColumn("_range", _digest_range(key)).join(F.broadcast(unlike), "_range", "left_semi").drop("_range")
        return cache_contents(rows, columns, key=key, seq=seq).select(F.col(key).alias(name), F.col("contents").alias(side))

    left, right = contents(a, "_ka", "contents_a"), contents(b, "_kb", "contents_b")
    pairs = left.join(right, F.col("_ka").eqNullSafe(F.col("_kb")), "full_outer")
    return pairs.filter(~F.col("contents_a").eqNullSafe(F.col("contents_b"))).select(
        F.coalesce("_ka", "_kb").alias(key), "contents_a", "contents_b"
    )
