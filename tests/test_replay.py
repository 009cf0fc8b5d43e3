"""Replay: goldens, properties and edge tables."""

import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rollwise.functions.rewards import plain_score, weighted_reward
from rollwise.operators import replay as R
from rollwise.operators.advantage import advantages
from rollwise.plans.fixtures import REWARDS, roll
from rollwise.plans.flagship import replay_advantages, replay_batch
from tests.conftest import SF_SMALL

LOG_SCHEMA = (
    "prompt_key long, rollout_id long, seq long, step long, slot int, block int, mode string, "
    "r_accuracy double, r_format double"
)


def make_log(spark, rows):
    """rows: (prompt_key, step, slot, r_accuracy, r_format[, block[, mode]]) in append order."""
    out = []
    for seq, r in enumerate(rows):
        pk, step, slot, acc, fmt = r[:5]
        block = r[5] if len(r) > 5 else 0
        mode = r[6] if len(r) > 6 else "train"
        out.append((pk, 1000 + seq, seq, step, slot, block, mode, acc, fmt))
    return spark.createDataFrame(out, LOG_SCHEMA)


def visits(pk, n_visits, g, score=lambda v, s: (1.0, 0.0)):
    return [(pk, v, s, *score(v, s)) for v in range(n_visits) for s in range(g)]


def chosen(spark, log, cfg):
    pos = R.with_positions(log).withColumn("score", plain_score(REWARDS))
    rows = R.replay_rows(pos, cfg).collect()
    return sorted((r.prompt_key, r.batch_step, r.batch_block, r.replay_slot, r.rollout_id) for r in rows)


def test_gate_timing_first_replay_at_visit_2(spark):
    out = replay_batch(roll(spark, SF_SMALL), R.ReplayConfig()).filter("is_online = 0")
    assert out.agg(F.min("batch_step")).first()[0] == 2


def test_flagship_counts_sf0001(spark):
    b = replay_batch(roll(spark, SF_SMALL), R.ReplayConfig())
    counts = {r.is_online: r["count"] for r in b.groupBy("is_online").count().collect()}
    assert counts == {1: 1000, 0: 816}


def test_fifo_bounded_and_replays_strictly_older(spark):
    log = roll(spark, SF_SMALL)
    st = R.fifo_state(log, 16)
    assert st.groupBy("prompt_key").count().agg(F.max("count")).first()[0] <= 16
    pos = R.with_positions(log).withColumn("score", plain_score(REWARDS))
    rep = R.replay_rows(pos, R.ReplayConfig(strategy="all", num_replays=0, min_cache=1, max_cache=16))
    first_seq = log.groupBy("prompt_key", F.col("step").alias("batch_step")).agg(F.min("seq").alias("s0"))
    bad = rep.join(first_seq, ["prompt_key", "batch_step"]).filter("seq >= s0").count()
    assert bad == 0
    sizes = rep.groupBy("prompt_key", "batch_step").count().agg(F.max("count")).first()[0]
    assert sizes <= 16


def test_advantages_sum_to_zero_per_group(spark):
    out = replay_advantages(roll(spark, SF_SMALL), R.ReplayConfig(), mode="split", scale_rewards=False)
    worst = out.groupBy("prompt_key", "batch_step", "batch_block", "is_online").agg(F.abs(F.sum("advantage")).alias("s"))
    assert worst.agg(F.max("s")).first()[0] < 1e-9


def test_k_zero_gives_no_rows_but_all(spark):
    log = make_log(spark, visits(1, 4, 4))
    for s in ("random_k", "highest_k", "recent_k", "max_variance_k"):
        assert chosen(spark, log, R.ReplayConfig(strategy=s, num_replays=0, min_cache=4, max_cache=8)) == []
    got = chosen(spark, log, R.ReplayConfig(strategy="all", num_replays=0, min_cache=4, max_cache=8))
    assert len(got) == 4 + 8 + 8  # visits 1, 2, 3 read buffers of 4, 8, 8 rows


def test_k_larger_than_buffer_takes_whole_buffer(spark):
    log = make_log(spark, visits(1, 3, 2))
    got = chosen(spark, log, R.ReplayConfig(strategy="highest_k", num_replays=50, min_cache=1, max_cache=3))
    per_step = {}
    for pk, st, bl, slot, rid in got:
        per_step.setdefault(st, []).append(rid)
    assert {k: len(v) for k, v in per_step.items()} == {1: 2, 2: 3}


def test_equal_scores_highest_k_keeps_older_first(spark):
    log = make_log(spark, visits(7, 3, 4, score=lambda v, s: (1.0, 1.0)))
    got = chosen(spark, log, R.ReplayConfig(strategy="highest_k", num_replays=3, min_cache=8, max_cache=8))
    assert [r[4] for r in got] == [1000, 1001, 1002]  # buffer before visit 2 = rows 0..7; oldest three


def test_all_missing_rewards(spark):
    log = make_log(spark, visits(3, 3, 2, score=lambda v, s: (None, None)))
    got = chosen(spark, log, R.ReplayConfig(strategy="highest_k", num_replays=1, min_cache=2, max_cache=4))
    assert [r[4] for r in got] == [1000, 1000]  # unscored rows rank by age
    b = replay_advantages(log, R.ReplayConfig(strategy="none"), mode="none")
    assert {r.reward for r in b.collect()} == {0.0}


def test_group_of_one_has_zero_advantage(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 1, 1.0), (1, 0, 0, 1, 0.0), (1, 0, 0, 0, 1.0)],
        "prompt_key long, batch_step long, batch_block int, is_online int, reward double",
    )
    out = advantages(df, "split").filter("is_online = 0").first()
    assert out.advantage == 0.0


def test_one_prompt_below_gate_gets_nothing(spark):
    log = make_log(spark, visits(5, 2, 3))
    assert chosen(spark, log, R.ReplayConfig(strategy="all", num_replays=0, min_cache=8, max_cache=8)) == []


def test_duplicate_prompt_in_one_step_reads_same_buffer(spark):
    rows = visits(9, 2, 2) + [(9, 2, s, 1.0, 0.0, 0) for s in range(2)] + [(9, 2, s, 1.0, 0.0, 1) for s in range(2)]
    log = make_log(spark, rows)
    got = chosen(spark, log, R.ReplayConfig(strategy="recent_k", num_replays=2, min_cache=4, max_cache=4))
    step2 = [r for r in got if r[1] == 2]
    assert sorted((r[2], r[4]) for r in step2) == [(0, 1002), (0, 1003), (1, 1002), (1, 1003)]


def test_eval_rows_stay_out_of_the_cache(spark):
    rows = [(4, v, s, 1.0, 0.0, 0, "eval" if v == 1 else "train") for v in range(3) for s in range(2)]
    log = make_log(spark, rows)
    got = chosen(spark, log, R.ReplayConfig(strategy="all", num_replays=0, min_cache=1, max_cache=8))
    assert {r[4] for r in got if r[1] == 2} == {1000, 1001}


def test_bad_configuration_is_rejected():
    with pytest.raises(ValueError):
        R.ReplayConfig(strategy="random").validate()
    with pytest.raises(ValueError):
        R.ReplayConfig(min_cache=16, max_cache=8).validate()


def _brute(scores, k):
    """The best subset by the rule (variance, then sum, then earliest members), over all subsets of scored rows."""

    def spread(members):
        values = [Fraction(scores[i]) for i in members]
        return len(values) * sum(v * v for v in values) - sum(values) ** 2, sum(values), [-i for i in members]

    have = [i for i in range(len(scores)) if scores[i] is not None]
    size = min(k, len(have))
    chosen = max(itertools.combinations(have, size), key=spread) if size else ()
    fill = [i for i in range(len(scores)) if scores[i] is None][: max(0, k - len(have))]
    return sorted([*chosen, *fill])


def test_max_variance_matches_brute_force(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    for b in range(300):
        n = rng.randint(1, 9)
        k = rng.randint(0, n + 1)
        scores = [rng.choice([0.0, 1.0, 2.0, 2.0, None]) for _ in range(n)]
        kk = min(n, k)
        picked = _brute(scores, kk)
        expect[b] = sorted(10 * b + i for i in picked)
        for i, s in enumerate(scores):
            rows.append((b, 0, 0, n, 10 * b + i, i, i, s, k))
    buf = spark.createDataFrame(
        rows,
        "prompt_key long, batch_step long, batch_block int, buf_size long, rollout_id long, seq long, buf_idx long, score double, k int",
    )
    got = {}
    for k in sorted({r[8] for r in rows}):
        part = buf.filter(F.col("k") == k)
        cfg = R.ReplayConfig(strategy="max_variance_k", num_replays=k, min_cache=0, max_cache=16)
        for r in R.choose(part, cfg).collect():
            got.setdefault(r.prompt_key, []).append(r.rollout_id)
    got = {b: sorted(v) for b, v in got.items()}
    mism = [b for b in expect if expect[b] != got.get(b, [])]
    assert not mism, [(b, expect[b], got.get(b)) for b in mism[:5]]


def test_weighted_reward_and_plain_score(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 1.0)], "r_accuracy double, r_format double")
    out = df.select(weighted_reward(REWARDS, [2.0, 0.5]).alias("w"), plain_score(REWARDS).alias("s")).collect()
    assert [(r.w, r.s) for r in out] == [(2.0, None), (0.0, None), (2.5, 2.0)]
    with pytest.raises(ValueError):
        weighted_reward(REWARDS, [1.0])


def test_hot_prompt_replay_matches_sql(spark):
    """A third of the log on one prompt, positions ranked over many small ranges: same replays as SQL."""
    import duckdb

    from rollwise.plans import fixtures as FX
    from rollwise.plans.q_replay import GRP, _replay_sql
    from tests.conftest import SF_MID

    hot_key = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    events = spark.read.parquet(f"{SF_MID}/events.parquet").withColumn("user_id", hot_key)
    view = f"hot_events_{abs(hash(SF_MID))}"
    events.createOrReplaceTempView(view)
    orig = FX.read_table
    FX.read_table = lambda s, d, name: s.table(view) if name == "events" else orig(s, d, name)
    try:
        log = FX.roll(spark, SF_MID, n_ranges=97)
    finally:
        FX.read_table = orig
    cfg = R.ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    pos = R.with_positions(log, n_ranges=97).withColumn("score", plain_score(REWARDS))
    got = {tuple(r) for r in R.replay_rows(pos, cfg).select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id").collect()}

    con = duckdb.connect()
    con.execute(
        f"CREATE VIEW events AS SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id) "
        f"FROM read_parquet('{SF_MID}/events.parquet')"
    )
    want = set(con.sql(f"WITH {_replay_sql('highest_k', 8, 16, 16)} SELECT {GRP}, replay_slot, rollout_id FROM chosen").fetchall())
    assert got == want
    assert len([r for r in got if r[0] == -1]) > 1000


def test_eval_rows_enter_the_cache_when_asked(spark):
    rows = [(4, v, s, 1.0, 0.0, 0, "eval" if v == 1 else "train") for v in range(3) for s in range(2)]
    log = make_log(spark, rows)
    cfg = R.ReplayConfig(strategy="all", num_replays=0, min_cache=1, max_cache=8, modes=("train", "eval"))
    got = R.replay_rows(R.with_positions(log, modes=cfg.modes).withColumn("score", plain_score(REWARDS)), cfg)
    ids = {r.rollout_id for r in got.filter("batch_step = 2").collect()}
    assert ids == {1000, 1001, 1002, 1003}


def test_incremental_replay_equals_full_history(spark):
    """Snapshot after steps < 5, then the later steps: the same replays as over the whole log."""
    log = roll(spark, SF_SMALL)
    pos = R.with_positions(log, position="fifo").withColumn("score", plain_score(REWARDS))
    for strategy in ("highest_k", "max_variance_k", "recent_k"):
        cfg = R.ReplayConfig(strategy=strategy, num_replays=6, min_cache=8, max_cache=12)
        full = R.replay_rows(pos, cfg).filter("batch_step >= 5")
        snapshot = R.fifo_state(pos.filter("step < 5"), cfg.max_cache, seq="pos").drop("age")
        inc, nxt = R.replay_increment(snapshot, pos.filter("step >= 5"), cfg)
        cols = ["prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id"]
        assert {tuple(r) for r in inc.select(*cols).collect()} == {tuple(r) for r in full.select(*cols).collect()}, strategy
    final = {tuple(r) for r in R.fifo_state(pos, 12, seq="pos").select("prompt_key", "rollout_id").collect()}
    assert {tuple(r) for r in nxt.select("prompt_key", "rollout_id").collect()} == final
    assert nxt.groupBy("prompt_key").count().agg(F.max("count")).first()[0] <= 12


def test_positions_do_not_depend_on_numbering(spark):
    """Global steps, several blocks, short groups, NULL keys: the buffer follows the append order alone."""
    rows = [(pk, 100 * v + (pk or 0), s, 1.0 * (s % 3), 0.0, s // 2) for v in range(6) for pk in (None, 1, 2) for s in range(5 if v % 2 else 4)]
    log = make_log(spark, rows)
    cfg = R.ReplayConfig(strategy="recent_k", num_replays=3, min_cache=6, max_cache=7)
    seen, want = {}, set()
    by_step = {}
    for seq, r in enumerate(rows):
        by_step.setdefault((r[0], r[1]), []).append((1000 + seq, r[5]))
    for (pk, step), members in by_step.items():
        buf = seen.setdefault(pk, [])[-7:]
        if len(buf) >= 6:
            want |= {(pk, step, b, i, x) for b in {b for _, b in members} for i, x in enumerate(buf[-3:])}
        seen[pk] += [x for x, _ in members]
    for n_ranges in (1, 4):
        pos = R.with_positions(log, n_ranges=n_ranges).withColumn("score", plain_score(REWARDS))
        got = {tuple(r) for r in R.replay_rows(pos, cfg).select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id").collect()}
        assert got == want


def test_gate_counts_rows_where_positions_have_gaps(spark):
    log = make_log(spark, visits(1, 4, 4)).withColumn("fifo", F.col("seq") * 3)
    cfg = R.ReplayConfig(strategy="all", num_replays=0, min_cache=4, max_cache=4)
    pos = R.with_positions(log, position="fifo").withColumn("score", plain_score(REWARDS))
    assert R.replay_rows(pos, cfg).count() == 0  # four positions hold two rows


def test_highest_k_zero_replays_nothing(spark):
    cfg = R.ReplayConfig(strategy="highest_k", num_replays=0, min_cache=4, max_cache=8)
    assert chosen(spark, make_log(spark, visits(1, 4, 4)), cfg) == []


def test_max_variance_far_from_zero(spark):
    """Adding 1e8 to every score changes no choice."""
    scores = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0]
    picks = []
    for shift in (0.0, 1e8):
        rows = [(1, 0, i, shift + x, 0.0) for i, x in enumerate(scores)] + [(1, 1, 0, 0.0, 0.0)]
        cfg = R.ReplayConfig(strategy="max_variance_k", num_replays=4, min_cache=10, max_cache=10)
        pos = R.with_positions(make_log(spark, rows)).withColumn("score", F.col("r_accuracy"))
        picks.append(sorted(r.rollout_id for r in R.replay_rows(pos, cfg).collect()))
    assert picks[0] == picks[1] and len(picks[0]) == 4


def test_top_k_prunes_before_the_shuffle(spark):
    """The partial group limit of the strategy lies below its exchange."""
    cfg = R.ReplayConfig(strategy="highest_k", num_replays=2, min_cache=4, max_cache=4)
    pos = R.with_positions(make_log(spark, visits(1, 4, 4))).withColumn("score", plain_score(REWARDS))
    plan = R.replay_rows(pos, cfg)._jdf.queryExecution().executedPlan().toString()
    limit = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in x for x in limit) and plan.index("Final") < plan.index("Partial")


def test_divergence_by_digests(spark, monkeypatch):
    """Changed, missing, added and NULL-key rows are found; ranges that agree send no row on."""
    rows = [(k if k else None, s, float(s % 3) if s % 5 else None, f"t{k}{s}") for k in range(60) for s in range(6)]
    schema = "prompt_key long, seq long, score double, text string"
    a = spark.createDataFrame(rows, schema)
    changed = [(k, s, 9.0 if (k, s) == (7, 2) else x, "u" if (k is None and s == 1) else t) for k, s, x, t in rows if k != 11 and (k, s) != (13, 0)]
    b = spark.createDataFrame(changed + [(99, 0, None, "new")], schema)
    for n in (1, 8, 4096):
        monkeypatch.setattr(R, "DIGEST_RANGES", n)
        got = {r.prompt_key: r for r in R.cache_divergence(a, b, ("score", "text")).collect()}
        assert set(got) == {None, 7, 11, 13, 99} and got[11].contents_b is None and got[99].contents_a is None
        assert len(got[13].contents_a) == 6 and len(got[13].contents_b) == 5
        assert R.cache_divergence(a, a.repartition(5), ("score", "text")).count() == 0
    same = R.cache_digests(a, ("score", "text")).join(R.cache_digests(b, ("score", "text")), ["range", "n", "d1", "d2"]).count()
    assert 40 < same < R.cache_digests(a, ("score", "text")).count()
