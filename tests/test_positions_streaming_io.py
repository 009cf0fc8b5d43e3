"""Skew-safe positions equal the plain window form; streaming equals batch; sinks round-trip."""

import json
import os
import uuid

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from rollwise.functions.rewards import plain_score
from rollwise.operators import replay as R
from rollwise.operators.positions import first_by, global_positions, rank_within_key, ranges
from rollwise.operators.prep import first_n
from rollwise.plans.fixtures import REWARDS, roll
from rollwise.session import checkpoint_path
from rollwise.sources import io as IO
from rollwise.streaming import replay_cache as RC
from rollwise.streaming import runner
from tests.conftest import SF_MID, SF_SMALL


def test_rank_within_key_matches_row_number(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("user_id", "event_id")
    ours = rank_within_key(ev, ["user_id"], "event_id", out="pos", n_ranges=40, count_col="n")
    plain = ev.withColumn("pos2", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    plain = plain.withColumn("n2", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    diff = ours.join(plain, ["user_id", "event_id"]).filter("pos <> pos2 OR n <> n2").count()
    assert diff == 0 and ours.count() == ev.count()


ORDERS = {"long": "h", "string": "concat('prefix-', hex(h))", "date": "date_add(DATE '1970-01-01', CAST(id AS INT))", "decimal": "CAST(h AS DECIMAL(25,3))", "double": "CAST(h AS DOUBLE)"}


@pytest.mark.parametrize("kind", ORDERS)
def test_ranks_of_any_orderable_type(spark, kind):
    """A key with a third of the rows, NULL keys and every size of range: equal to one window per key, small tasks."""
    base = spark.range(30_000).withColumn("h", F.xxhash64("id"))
    base = base.withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 100))
    df = base.select("k", F.expr(ORDERS[kind]).alias("o"))
    w = Window.partitionBy("k")
    plain = df.select(F.col("k").alias("k2"), F.col("o").alias("o2"), (F.row_number().over(w.orderBy("o")) - 1).alias("p2"), F.count("*").over(w).alias("n2"))
    for n_ranges in (1, 30):
        ours = rank_within_key(df, ["k"], "o", out="pos", n_ranges=n_ranges, count_col="n")
        both = ours.join(plain, F.col("k").eqNullSafe(F.col("k2")) & (F.col("o") == F.col("o2")))
        assert both.count() == 30_000 and both.filter("pos <> p2 OR n <> n2").count() == 0
    sizes = ranges(df, "o", 30).tag(df, "o").groupBy("_rw_range").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 3 * 30_000 / 30 and sizes[1] >= 20


def test_ranks_by_an_order_of_few_values(spark):
    """A table read from files whose order has few values: some ranges have no splitters of their own."""
    turns = spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn")
    w = Window.partitionBy("conv_id")
    plain = turns.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), (F.row_number().over(w.orderBy("turn")) - 1).alias("p2"))
    for n_ranges in (2, 4, 9):
        ours = rank_within_key(turns, ["conv_id"], "turn", out="pos", n_ranges=n_ranges)
        both = ours.join(plain, (F.col("conv_id") == F.col("c2")) & (F.col("turn") == F.col("t2")))
        assert both.count() == turns.count() and both.filter("pos <> p2").count() == 0


def test_first_rows_by_a_string_key_of_many_rows(spark):
    df = spark.range(200_000).select(F.concat(F.lit("key-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("k"), "id")
    assert sorted(r["id"] for r in first_n(df, "k", 5).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r["id"] for r in first_by(df, "k", 3, newest=True).collect()) == [199_997, 199_998, 199_999]


def test_global_positions_match_global_order(spark):
    c = spark.read.parquet(f"{SF_MID}/customer.parquet").select("c_custkey")
    c = c.withColumn("h", F.md5(F.concat(F.lit("42:"), F.col("c_custkey").cast("string"))))
    ours = global_positions(c, "h", "c_custkey", out="g", prefix_chars=2)
    plain = c.withColumn("g2", F.row_number().over(Window.orderBy("h", "c_custkey")) - 1)
    assert ours.join(plain, ["c_custkey"]).filter("g <> g2").count() == 0


def _batch_replays(spark, cfg):
    pos = R.with_positions(roll(spark, SF_SMALL)).withColumn("score", plain_score(REWARDS))
    return {tuple(r) for r in R.replay_rows(pos, cfg).select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id").collect()}


def test_streaming_equals_batch_for_every_strategy(spark):
    log = roll(spark, SF_SMALL).withColumn("score", plain_score(REWARDS))
    for strategy, k in (("max_variance_k", 6), ("random_k", 5), ("recent_k", 3), ("all", 0)):
        cfg = R.ReplayConfig(strategy=strategy, num_replays=k, min_cache=8, max_cache=12)
        base = runner.run_folder(spark, f"test-{strategy}")
        glob = runner.stage_in_order(log, f"{base}/source", "seq", 4)
        stream = runner.file_stream(spark, glob, log.schema, max_files=1)
        runner.append_to_parquet(RC.streaming_replays(stream, cfg), f"{base}/sink", f"{base}/chk")
        got = {tuple(r) for r in spark.read.parquet(f"{base}/sink").select("prompt_key", "batch_step", "batch_block", "replay_slot", "rollout_id").collect()}
        assert got == _batch_replays(spark, cfg), strategy


def test_sinks_round_trip(spark):
    base = checkpoint_path(spark, f"test-io-{uuid.uuid4().hex[:12]}")
    assert IO.prepared_folder(1024, None) == "DeepMath-1024samples"
    assert IO.prepared_folder(None, 4096) == "DeepMath-allsamples-maxlen4096"
    prep = spark.createDataFrame(
        [([("user", "q")], [("user", "q"), ("assistant", "a")], "a", "1", "train")],
        "prompt array<struct<role:string,content:string>>, messages array<struct<role:string,content:string>>, "
        "solution string, ground_truth string, split string",
    )
    path = IO.write_prepared(prep, base, 1024, None)
    back = IO.read_prepared(spark, path)
    assert "messages" not in back.columns and back.count() == 1

    bench = spark.createDataFrame([("gsm8k", "p", "1"), ("math500", "q", "2")], "dataset string, problem string, answer string")
    IO.write_benchmarks(bench, f"{base}/bench")
    assert sorted(r.dataset for r in IO.read_benchmarks(spark, f"{base}/bench").collect()) == ["gsm8k", "math500"]

    summ = spark.createDataFrame([("de", "total", 3.0), ("de", "pass@1", 0.5)], "dataset string, metric string, value double")
    IO.write_metric_summary(summ, f"{base}/summary")
    doc = [json.loads(line) for f in os.listdir(f"{base}/summary") if f.endswith(".json") for line in open(f"{base}/summary/{f}")]
    assert doc == [{"dataset": "de", "metrics": {"total": 3.0, "pass@1": 0.5}}]

    inf = spark.createDataFrame([("fr", "Ééé ç")], "dataset string, output string")
    IO.write_inferences(inf, f"{base}/inf")
    text = "".join(open(f"{base}/inf/{f}", encoding="utf-8").read() for f in os.listdir(f"{base}/inf") if f.endswith(".json"))
    assert "Ééé ç" in text

    comp = spark.createDataFrame([(0, "p", "c", 1.0), (1, "p", "d", None)], "step long, prompt string, completion string, r_accuracy double")
    IO.write_completions(comp, f"{base}/comp")
    IO.write_completions(comp, f"{base}/comp")
    IO.write_completions(comp.filter("step = 1").withColumn("completion", F.lit("later")), f"{base}/comp")
    assert sorted((r.step, r.completion) for r in spark.read.parquet(f"{base}/comp").collect()) == [(0, "c"), (1, "later")]

    rolls = spark.createDataFrame(
        [(1, 7, 3, 0, 0, 11, 1, 0.5), (2, 7, 3, 0, 1, 12, 0, 1.0)],
        "rollout_id long, prompt_key long, batch_step long, batch_block int, batch_slot long, seq long, is_online int, r_format double",
    )
    IO.append_rollouts(rolls, f"{base}/log")
    back = IO.read_rollout_log(spark, f"{base}/log").collect()
    assert [(r.rollout_id, r.prompt_key, r.step, r.seq, r.r_format, r.r_accuracy) for r in back] == [(1, "7", 3, 11, 0.5, None)]
    with pytest.raises(ValueError):
        IO.append_rollouts(rolls.drop("seq"), f"{base}/log")


def test_appends_can_be_retried(spark):
    """Twice the same rows, a job that dies midway, and its retry: the log holds every row once."""
    log = checkpoint_path(spark, f"test-log-{uuid.uuid4().hex[:12]}")
    rows = spark.createDataFrame([(i, f"p{i % 2}", 0, i) for i in range(40)], "rollout_id long, prompt_key string, step long, seq long").repartition(8)
    ids = lambda: sorted(r.rollout_id for r in IO.read_rollout_log(spark, log).collect())
    assert ids() == []
    first = IO.append_rollouts(rows.filter("seq < 20"), log)
    assert IO.append_rollouts(rows.filter("seq < 20").repartition(3), log) == first and ids() == list(range(20))
    dies = rows.filter("seq >= 20").withColumn("seq", F.when(F.col("seq") == 33, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("seq")))
    with pytest.raises(Exception, match="lost"):
        IO.append_rollouts(dies, log, batch_id="step-1")
    assert ids() == list(range(20))
    # files of a batch that was never committed are no part of the log either
    rows.limit(3).write.parquet(f"{log}/{IO.BATCHES}/batch_id=step-2")
    IO.append_rollouts(rows.filter("seq >= 20"), log, batch_id="step-1")
    IO.append_rollouts(rows.filter("seq >= 20"), log, batch_id="step-1")
    assert ids() == list(range(40)) and IO.committed(spark, log) == sorted([first, "step-1"])
    with pytest.raises(ValueError):
        IO.append_rollouts(rows, log, batch_id="../elsewhere")


def test_hot_key_is_spread_over_tasks(spark):
    """One prompt holding a third of the log: its positions are computed in many tasks."""
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("user_id", "event_id")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = rank_within_key(hot, ["user_id"], "event_id", out="pos", n_ranges=7)
        parts = ranked.filter("user_id = -1").select(F.spark_partition_id().alias("p")).distinct().count()
        n_hot = hot.filter("user_id = -1").count()
        ok = ranked.filter("user_id = -1").agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1
    assert tuple(ok) == (0, n_hot - 1, n_hot)
