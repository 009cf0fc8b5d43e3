"""Registered round trips through the sources and sinks.

Each query writes derived tables under the session's checkpoint folder (a fresh folder per
call) with the library's writer and returns what the matching reader gives back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollwise.functions.text import render_chat
from rollwise.operators import evaluation as E
from rollwise.operators import prep as P
from rollwise.operators.benchmarks import normalize, union_benchmarks
from rollwise.plans.fixtures import EVAL_SQL, ROLL_SQL, bench_sources, eval_rows, raw_training, roll
from rollwise.plans.flagship import FLAGSHIP, replay_batch
from rollwise.plans.q_eval import _METRICS_SQL, N_SAMPLES, _datasets
from rollwise.plans.q_prep import _RAW_SQL, _UNION_SQL, EOS_NL
from rollwise.plans.registry import register
from rollwise.session import checkpoint_path
from rollwise.sources import io as IO
from rollwise.sources.tables import read_table


def _folder(spark, name: str) -> str:
    return checkpoint_path(spark, f"io-{name}-{uuid.uuid4().hex[:12]}")


@register(
    "s1_read_raw_training",
    f"""WITH {_RAW_SQL}
SELECT question, solution AS r1_solution_1, regexp_extract(solution, '(\\S+)\\s*$', 1) AS final_answer,
       CASE WHEN conv_id % 10 = 0 THEN 'test' WHEN conv_id % 10 = 1 THEN NULL ELSE 'train' END AS split FROM raw""",
)
def s1_read_raw_training(spark, sf):
    base = _folder(spark, "s1")
    split = F.when(F.col("conv_id") % 10 == 0, "test").when(F.col("conv_id") % 10 != 1, "train")
    raw_training(spark, sf).withColumn("split", split).drop("conv_id").write.json(f"{base}/raw")
    return IO.read_raw_training(spark, f"{base}/raw", fmt="json")


@register("s2_read_benchmark_specs", _UNION_SQL)
def s2_read_benchmark_specs(spark, sf):
    base = _folder(spark, "s2")
    specs = []
    for alias, df in bench_sources(spark, sf).items():
        df.write.parquet(f"{base}/{alias}")
        specs.append({"path": f"{base}/{alias}", "alias": alias})
    return IO.read_benchmark_sources(spark, specs)


@register("s6_benchmarks_roundtrip", _UNION_SQL)
def s6_benchmarks_roundtrip(spark, sf):
    """S6 write, one folder per dataset, then S4 read."""
    base = _folder(spark, "s6")
    union = union_benchmarks(normalize(df, alias) for alias, df in bench_sources(spark, sf).items())
    IO.write_benchmarks(union, f"{base}/bench")
    return IO.read_benchmarks(spark, f"{base}/bench")


@register(
    "s5_prepared_roundtrip",
    f"""WITH {_RAW_SQL}
SELECT conv_id, '<|user|>' || chr(10) || question || {EOS_NL} AS prompt_rendered, solution, regexp_extract(solution, '(\\S+)\\s*$', 1) AS ground_truth,
       CASE WHEN conv_id % 10 = 0 THEN 'test' ELSE 'train' END AS split, 'DeepMath-allsamples-maxlen4096' AS folder
FROM raw""",
)
def s5_prepared_roundtrip(spark, sf):
    """S5 write (folder named from the parameters, split as partition) and S3 read (no ``messages``)."""
    base = _folder(spark, "s5")
    raw = raw_training(spark, sf).withColumn(
        "split", F.when(F.col("conv_id") % 10 == 0, F.lit("test")).otherwise(F.lit("train"))
    )
    prepared = P.training_projection(raw, keep=("conv_id", *P.TRAINING_COLUMNS, "split"))
    path = IO.write_prepared(prepared, base, None, 4096)
    back = IO.read_prepared(spark, path)
    return back.select(
        "conv_id",
        render_chat("prompt").alias("prompt_rendered"),
        "solution",
        "ground_truth",
        "split",
        F.lit(path.rsplit("/", 1)[-1]).alias("folder"),
    )


@register(
    "s7_metric_summary",
    f"""{_METRICS_SQL}
SELECT dataset, 'pass@' || k AS metric, round(pass_at_k, 6) AS value FROM m
UNION ALL SELECT dataset, 'avg@' || k, round(avg_at_k, 6) FROM m
UNION ALL SELECT DISTINCT dataset, 'total', CAST(total AS DOUBLE) FROM m""",
)
def s7_metric_summary(spark, sf):
    base = _folder(spark, "s7")
    summary = E.summary(E.dataset_metrics(eval_rows(spark, sf), _datasets(spark, sf), N_SAMPLES))
    IO.write_metric_summary(summary.select("dataset", "metric", F.round("value", 6).alias("value")), f"{base}/summary")
    return IO.read_metric_summary(spark, f"{base}/summary")


@register(
    "s8_inferences",
    f"""WITH {EVAL_SQL}
SELECT dataset, problem, sample_idx, CAST(length(output) AS BIGINT) AS output_len, flag FROM ev""",
)
def s8_inferences(spark, sf):
    base = _folder(spark, "s8")
    IO.write_inferences(eval_rows(spark, sf).drop("doc_id"), f"{base}/inferences")
    schema = "dataset string, problem string, sample_idx long, output string, flag double"
    back = spark.read.schema(schema).json(f"{base}/inferences")
    return back.select("dataset", "problem", "sample_idx", F.length("output").cast("bigint").alias("output_len"), "flag")


@register(
    "s9_completions_table",
    f"""WITH {ROLL_SQL}
SELECT r.step, c.c_name AS prompt, r.completion, r.r_accuracy, r.r_format
FROM roll r JOIN customer c ON c.c_custkey = r.prompt_key""",
)
def s9_completions_table(spark, sf):
    base = _folder(spark, "s9")
    prompts = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("prompt_key"), F.col("c_name").alias("prompt"))
    table = roll(spark, sf).join(prompts, "prompt_key").select("step", "prompt", "completion", "r_accuracy", "r_format")
    IO.write_completions(table, f"{base}/completions")
    back = spark.read.parquet(f"{base}/completions")
    return back.select(F.col("step").cast("bigint").alias("step"), "prompt", "completion", "r_accuracy", "r_format")


@register(
    "s10_rollout_append",
    f"""WITH {ROLL_SQL}
SELECT rollout_id, CAST(prompt_key AS VARCHAR) AS prompt_key, mode, step, block, visit, slot, seq, completion, r_accuracy, r_format FROM roll""",
)
def s10_rollout_append(spark, sf):
    """Append the merged batch: only its online rows reach the log, in the schema the library reads back."""
    base = _folder(spark, "s10")
    batch = replay_batch(roll(spark, sf), FLAGSHIP, payload=("mode", "visit", "seq", "completion"), position="fifo")
    IO.append_rollouts(batch, f"{base}/log")
    back = IO.read_rollout_log(spark, f"{base}/log")
    return back.select("rollout_id", "prompt_key", "mode", "step", "block", "visit", "slot", "seq", "completion", "r_accuracy", "r_format")
