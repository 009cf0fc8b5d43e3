"""Streaming replay with its state in a table: equal to the batch replay, also for a hot prompt, retries and failures."""

import os

import pytest
from pyspark.sql import functions as F

from rollwise.operators import positions
from rollwise.operators import replay as R
from rollwise.operators.replay import ReplayConfig
from rollwise.plans import q_streaming
from rollwise.plans.fixtures import roll
from rollwise.streaming import replay_tables as RT
from rollwise.streaming import runner

COLUMNS = ["prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id"]


def make_log(spark, n=6_000):
    """Prompt 0 holds two thirds of the rows, prompt NULL some; steps of 6 rows in two blocks; eval rows between."""
    rows = spark.range(n).withColumn("prompt_key", F.expr("CASE WHEN id % 3 > 0 THEN 0 WHEN id % 21 = 0 THEN NULL ELSE id % 7 END"))
    return rows.select(
        "prompt_key", F.col("id").alias("rollout_id"), F.col("id").alias("seq"), F.expr("floor(id / 60)").alias("step"),
        F.expr("CAST(id % 2 AS INT)").alias("block"), F.expr("CASE WHEN id % 11 > 0 THEN CAST(pmod(hash(id), 5) AS DOUBLE) END").alias("score"),
        F.expr("CASE WHEN id % 13 = 0 THEN 'eval' ELSE 'train' END").alias("mode"),
    )


def batch(log, cfg):
    return listed(R.replay_rows(R.with_positions(log), cfg))


def listed(replays):
    return sorted((tuple(r) for r in replays.select(*COLUMNS).collect()), key=str)


def parts(log, cuts):
    edges = [0, *cuts, 1 << 40]
    return [log.filter((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip(edges, edges[1:], strict=False)]


@pytest.mark.parametrize("strategy", ["all", "highest_k", "max_variance_k"])
def test_equals_batch_wherever_triggers_cut(spark, strategy):
    """Cuts fall inside steps and blocks; one trigger is empty; full states every second trigger."""
    cfg = ReplayConfig(strategy=strategy, num_replays=3, min_cache=4, max_cache=7)
    log, folder = make_log(spark, 900), runner.run_folder(spark, f"tables-{strategy}")
    run = RT.replay_trigger(cfg, folder, full_every=2)
    for n, part in enumerate(parts(log, [1, 64, 64, 215, 700])):
        run(part, n)
    assert listed(RT.read_replays(spark, folder, log.schema["prompt_key"].dataType)) == batch(log, cfg)
    sizes = RT.states(spark, folder, log.schema["prompt_key"].dataType).groupBy("prompt_key").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * cfg.max_cache


def test_a_stream_of_files(spark):
    cfg = ReplayConfig(strategy="highest_k", num_replays=3, min_cache=4, max_cache=7)
    log, folder = make_log(spark, 900).coalesce(1), runner.run_folder(spark, "tables-files")  # one file per append: files come in order
    stream = runner.file_stream(spark, runner.stage_in_order(log, f"{folder}/source", "seq", 3), log.schema)
    assert listed(RT.run_replays(stream, cfg, f"{folder}/replay")) == batch(log, cfg)


def test_a_failed_and_a_repeated_trigger(spark, monkeypatch):
    cfg = ReplayConfig(strategy="highest_k", num_replays=3, min_cache=4, max_cache=7)
    log, folder = make_log(spark, 900), runner.run_folder(spark, "tables-retry")
    key_type = log.schema["prompt_key"].dataType
    first, second, third = parts(log, [300, 600])
    run = RT.replay_trigger(cfg, folder)
    run(first, 0)
    after_first = listed(RT.read_replays(spark, folder, key_type))
    whole_fs = RT._fs

    def no_marker(spark_, path):
        if "/commits/1" in path:
            raise OSError("lost before the commit")
        return whole_fs(spark_, path)

    monkeypatch.setattr(RT, "_fs", no_marker)
    with pytest.raises(OSError):
        run(second, 1)
    monkeypatch.undo()
    assert listed(RT.read_replays(spark, folder, key_type)) == after_first  # nothing of it counts
    run(second, 1)
    run(second, 1)
    run(third, 2)
    assert listed(RT.read_replays(spark, folder, key_type)) == batch(log, cfg)


def test_a_hot_prompt_in_one_trigger_is_spread(spark):
    """100,000 rows of one prompt in one trigger: no task of the buffers or states holds many of them."""
    cfg = ReplayConfig(strategy="highest_k", num_replays=3, min_cache=4, max_cache=16)
    log = make_log(spark, 100_000).withColumn("prompt_key", F.lit(1)).withColumn("mode", F.lit("train"))
    rows = log.select("prompt_key", "rollout_id", "seq", "score", "step", "block")
    before = spark.createDataFrame([], RT._state_schema(log.schema["prompt_key"].dataType))
    numbered, replays, kept = RT.advance(before, rows, cfg, n_ranges=20)
    spread = numbered.withColumn("_rng", F.floor(F.col("pos") / 16)).repartition(8, "prompt_key", "_rng").groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 100_000 / 4
    assert listed(replays) == batch(log, cfg)
    assert kept.count() <= 2 * cfg.max_cache
    numbered.unpersist()


def test_empty_stream(spark):
    cfg = ReplayConfig(strategy="highest_k", num_replays=3, min_cache=4, max_cache=7)
    log, folder = make_log(spark, 0), runner.run_folder(spark, "tables-empty")
    RT.replay_trigger(cfg, folder)(log, 0)
    assert listed(RT.read_replays(spark, folder, log.schema["prompt_key"].dataType)) == []


def test_st1_table_replay_has_one_trigger_an_append(spark, tmp_path, monkeypatch):
    """Appends of several files, each with rows of all prompts in no order: a trigger is a whole append, however many files it has."""
    events = spark.range(4_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_seconds(1700000000 + id)").alias("ts"), F.expr("id % 7").alias("user_id"),
        F.expr("CASE id % 4 WHEN 0 THEN 'purchase' WHEN 1 THEN 'error' ELSE 'view' END").alias("event_type"),
        F.expr("CAST(pmod(hash(id), 100) AS DOUBLE)").alias("value"), F.lit('{"k": 3}').alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    base = runner.run_folder(spark, "tables-appends")
    monkeypatch.setattr(runner, "run_folder", lambda *_: base)
    monkeypatch.setattr(positions, "ROWS_PER_RANGE", 200)  # a prompt's rows are dealt over many files
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        found = listed(q_streaming._table_query("st1t")(spark, str(tmp_path)))
        log = roll(spark, str(tmp_path)).withColumn("score", q_streaming.plain_score(q_streaming.REWARDS))
        wanted = batch(log, ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16))
    finally:
        spark.conf.set(coalesce, was)
    local = base.removeprefix("file:")
    files = [sum(f.endswith(".parquet") for f in os.listdir(f"{local}/source/{k:05d}")) for k in range(q_streaming.CHUNKS)]
    assert min(files) > 1
    assert len([f for f in os.listdir(f"{local}/replay/commits") if not f.startswith(".")]) == q_streaming.CHUNKS
    assert len(found) > 3_000
    assert found == wanted
