"""The end-to-end jobs agree with the operators they compose."""

import uuid

from pyspark.sql import functions as F

from rollwise.functions.grading import with_accuracy
from rollwise.functions.text import render_chat, word_count
from rollwise.operators import evaluation as E
from rollwise.operators.positions import rank_within_key
from rollwise.operators.replay import ReplayConfig
from rollwise.plans import jobs
from rollwise.plans.fixtures import G, bench_sources, raw_training, roll
from rollwise.plans.q_replay import v3_split_advantage
from rollwise.session import checkpoint_path
from rollwise.sources.tables import read_table
from tests.conftest import SF_SMALL


def _folder(spark, name):
    return checkpoint_path(spark, f"test-jobs-{name}-{uuid.uuid4().hex[:12]}")


def test_prepare_training_table(spark):
    raw = raw_training(spark, SF_SMALL).withColumn(
        "split", F.when(F.col("conv_id") % 4 == 0, "test").otherwise("train")
    ).drop("conv_id")
    path, sizes = jobs.prepare_training_table(spark, raw, _folder(spark, "prep"), sample_size=5, max_length=300)
    assert path.endswith("DeepMath-5samples-maxlen300")
    got = {r.split: r.n_rows for r in sizes.collect()}
    msgs = F.array(
        F.struct(F.lit("user").alias("role"), F.col("question").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("r1_solution_1").alias("content")),
    )
    short = raw.filter(word_count(render_chat(msgs)) < 300)
    assert got["train"] == min(5, short.filter("split = 'train'").count())
    assert got.get("test", 0) == short.filter("split = 'test'").count()


def test_build_benchmarks(spark):
    base = _folder(spark, "bench")
    specs = []
    for alias, df in bench_sources(spark, SF_SMALL).items():
        df.write.parquet(f"{base}/{alias}")
        specs.append({"path": f"{base}/{alias}", "alias": alias})
    aliases = jobs.build_benchmarks(spark, specs, f"{base}/combined")
    assert sorted(r.dataset for r in aliases.collect()) == ["aime24", "gsm8k", "math500", "olympiadbench"]


def test_evaluate_outputs_matches_operators(spark):
    part = read_table(spark, SF_SMALL, "part")
    size = F.col("p_size").cast("string")
    pred = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("\\boxed{"), size, F.lit("}"))).otherwise(F.lit("no"))
    outputs = part.select(
        F.col("p_type").alias("dataset"),
        F.concat(F.lit("size "), size).alias("problem"),
        F.concat(F.lit("\\boxed{"), size, F.lit("}")).alias("answer"),
        "p_partkey",
        pred.alias("prediction"),
    )
    results = outputs.groupBy("dataset", "problem", "answer").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "prediction"))), lambda x: x["prediction"]).alias("outputs")
    )
    summary, report = jobs.evaluate_outputs(spark, results, _folder(spark, "eval"), num_samples=4)
    graded = with_accuracy(outputs, "prediction", "answer", "flag")
    ranked = rank_within_key(graded, ["dataset", "problem"], "p_partkey", out="sample_idx")
    want = E.summary(E.dataset_metrics(ranked, outputs.select("dataset"), 4))
    a = {(r.dataset, r.metric): round(r.value, 9) for r in summary.collect()}
    b = {(r.dataset, r.metric): round(r.value, 9) for r in want.collect()}
    assert a == b and len(a) > 0
    assert report.agg(F.sum("skipped")).first()[0] == 0


def test_replay_step_tables_match_flagship(spark):
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    batch, metrics = jobs.replay_step_tables(roll(spark, SF_SMALL), cfg)
    assert batch.count() == 1816 and metrics.count() > 0
    from rollwise import schemas

    schemas.check(metrics, schemas.METRICS)
    mine = {(r.rollout_id, r.batch_step, r.is_online): round(r.advantage, 6) for r in batch.collect()}
    flag = {(r.rollout_id, r.batch_step, r.is_online): r.advantage for r in v3_split_advantage(spark, SF_SMALL).collect()}
    assert mine == flag


def test_evaluate_outputs_reports_skipped_datasets(spark):
    results = spark.createDataFrame(
        [("short", "p1", "\\boxed{1}", ["\\boxed{1}", "no"]),
         ("long", " ".join(["w"] * 50), "\\boxed{2}", ["\\boxed{2}"])],
        "dataset string, problem string, answer string, outputs array<string>",
    )
    summary, report = jobs.evaluate_outputs(spark, results, _folder(spark, "skip"), num_samples=2, max_tokens=20)
    vals = {(r.dataset, r.metric): r.value for r in summary.collect()}
    assert vals[("short", "total")] == 1.0 and vals[("short", "pass@1")] == 1.0 and vals[("short", "avg@2")] == 0.5
    assert vals[("long", "total")] == 0.0 and vals[("long", "pass@1")] == 0.0
    assert {r.dataset: (r.kept, r.skipped) for r in report.collect()} == {"short": (1, 0), "long": (0, 1)}


def test_evaluation_counts_rows_not_texts(spark):
    """A repeated problem text and a row without outputs are problems of their own."""
    results = spark.createDataFrame(
        [("d", "p", "\\boxed{1}", ["\\boxed{1}"]), ("d", "p", "\\boxed{2}", ["\\boxed{1}"]), ("d", "q", "\\boxed{3}", [])],
        "dataset string, problem string, answer string, outputs array<string>",
    )
    summary, _ = jobs.evaluate_outputs(spark, results, _folder(spark, "rows"), num_samples=1)
    vals = {r.metric: r.value for r in summary.collect()}
    assert vals["total"] == 3.0 and abs(vals["pass@1"] - 1 / 3) < 1e-12


def test_eval_rows_keep_their_mode_in_batch_and_metrics(spark):
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    log = roll(spark, SF_SMALL).withColumn("mode", F.when(F.col("prompt_key") % 5 == 0, "eval").otherwise("train"))
    batch, metrics = jobs.replay_step_tables(log, cfg, payload=("completion_len", "prompt_len", "terminated"), prompt_length="prompt_len")
    by_mode = {(r["mode"], r["is_online"]): r["count"] for r in batch.groupBy("mode", "is_online").count().collect()}
    assert by_mode[("eval", 1)] == log.filter("mode = 'eval'").count() and ("eval", 0) not in by_mode and by_mode[("train", 0)] > 0
    assert {r["mode"] for r in metrics.select("mode").distinct().collect()} == {"train", "eval"}


def test_incremental_job_equals_full_job(spark):
    cfg = ReplayConfig(strategy="highest_k", num_replays=8, min_cache=16, max_cache=16)
    log = roll(spark, SF_SMALL)
    full, _ = jobs.replay_step_tables(log, cfg)
    b1, snap = jobs.replay_increment_tables(None, log.filter("step < 4"), cfg)
    b2, _ = jobs.replay_increment_tables(snap, log.filter("step >= 4"), cfg)
    key = lambda r: (r.rollout_id, r.batch_step, r.is_online)
    got = {key(r): round(r.advantage, 9) for r in b1.unionByName(b2).collect()}
    want = {key(r): round(r.advantage, 9) for r in full.collect()}
    assert got == want and len(got) == 1816
