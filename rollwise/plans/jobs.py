"""End-to-end jobs for the three workflows a user runs: preparing a training table, building
and evaluating benchmarks, and the tables of one training step with replay.

Each job is one lazy plan per output, written by the library's writers; nothing passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.functions.grading import with_accuracy
from rollwise.functions.rewards import weighted_reward
from rollwise.functions.text import fill_template, render_chat, trim_ws, word_count
from rollwise.operators import evaluation as E
from rollwise.operators import loss as L
from rollwise.operators import metrics as M
from rollwise.operators import prep as P
from rollwise.operators import tokens as TK
from rollwise.operators.advantage import advantages
from rollwise.functions.rewards import plain_score
from rollwise.operators import replay as R
from rollwise.operators.replay import ReplayConfig
from rollwise.plans.flagship import replay_batch
from rollwise.sources import io as IO


def prepare_training_table(
    spark: SparkSession,
    raw: DataFrame | str,
    out_root: str,
    *,
    sample_size: int | None = None,
    max_length: int | None = 4096,
    seed: int = 42,
    n_tokens: str | None = None,
) -> tuple[str, DataFrame]:
    """Raw rows (``question, r1_solution_1, final_answer[, split]``) -> prepared table on disk.

    P1/P2 projection, F1 length filter on the rendered messages (``< max_length`` tokens,
    skipped when None), T1 seeded sample of the train split, S5 write. Rows without a split
    are training rows. ``n_tokens`` names a token count column of the raw rows; without it
    the white-space words of the rendering are counted. Returns the folder and the split sizes (A9).
    """
    df = IO.read_raw_training(spark, raw) if isinstance(raw, str) else raw
    given = F.col("split") if "split" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("split", F.coalesce(given, F.lit("train")))
    prepared = P.training_projection(df, keep=(*P.TRAINING_COLUMNS, "split", *([n_tokens] if n_tokens else [])))
    if max_length is not None:
        prepared = P.length_filter(prepared, F.col(n_tokens) if n_tokens else word_count(render_chat("messages")), max_length)
    # the sample order needs a stable key per row: a hash of the whole row (equal rows are interchangeable)
    keyed = prepared.withColumn("_key", F.sha2(F.to_json(F.struct(*prepared.columns)), 256))
    prepared = P.seeded_sample(keyed, "_key", sample_size, seed=seed)
    path = IO.write_prepared(prepared.drop("_key"), out_root, sample_size, max_length)
    return path, P.split_sizes(IO.read_prepared(spark, path))


def build_benchmarks(spark: SparkSession, specs: Iterable[Mapping[str, str]], out_path: str) -> DataFrame:
    """S2 + N1-N4 + U1 + S6: read every source, normalise, union, write; returns the aliases."""
    IO.write_benchmarks(IO.read_benchmark_sources(spark, specs), out_path)
    return IO.read_benchmarks(spark, out_path).select("dataset").distinct()


def evaluate_outputs(
    spark: SparkSession,
    results: DataFrame,
    out_root: str,
    *,
    num_samples: int,
    prompt_type: str | None = None,
    max_tokens: int | None = None,
    n_tokens: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Generated outputs (``[problem_id, ]dataset, problem, answer, outputs ARRAY<STRING>``) -> metrics.

    Every input row is a problem of its own, also when texts repeat or ``outputs`` is empty;
    ``problem_id`` tells them apart (numbered where it is missing). ``n_tokens`` names a token
    count column of the prompts; without it white-space words of the rendering are counted.

    F2 drops problems whose rendered prompt is longer than ``max_tokens`` (and reports them),
    P10/P8 explode and trim the outputs, G3 grades each against the answer, E1-E5 compute
    pass@k / avg@k per dataset; S7 and S8 write the summary and the inferences. Returns the
    summary and the length-filter report.
    """
    msgs = F.array(F.struct(F.lit("user").alias("role"), fill_template("problem", prompt_type).alias("content")))
    if "problem_id" not in results.columns:
        results = results.withColumn("problem_id", F.monotonically_increasing_id())
    with_len = results.withColumn("_n_tokens", F.col(n_tokens) if n_tokens else word_count(render_chat(msgs, add_generation_prompt=True)))
    report = E.length_filter_report(with_len, F.col("_n_tokens"), max_tokens if max_tokens is not None else 1 << 62)
    kept = P.length_filter(with_len, F.col("_n_tokens"), max_tokens, inclusive=True)
    kept = kept.drop("_n_tokens").withColumn("outputs", F.transform("outputs", trim_ws))
    long = kept.select("problem_id", "dataset", "answer", F.posexplode_outer("outputs").alias("sample_idx", "output"))
    graded = with_accuracy(long, "output", "answer", "flag")
    metrics = E.dataset_metrics(graded, results.select("dataset"), num_samples, problem="problem_id")
    IO.write_metric_summary(E.summary(metrics), f"{out_root.rstrip('/')}/metrics_summary")
    inferences = kept.withColumn("prompt_type", F.lit(prompt_type).cast("string"))
    IO.write_inferences(inferences.select("dataset", "problem", "answer", "prompt_type", "outputs"), f"{out_root.rstrip('/')}/inference_summary")
    return IO.read_metric_summary(spark, f"{out_root.rstrip('/')}/metrics_summary"), report


def replay_step_tables(
    log: DataFrame,
    cfg: ReplayConfig,
    *,
    mode: str = "split",
    rewards: Sequence[str] = ("r_accuracy", "r_format"),
    weights: Sequence[float] | None = None,
    position: str | None = None,
    payload: Sequence[str] = ("completion_len", "terminated"),
    prompt_length: str | None = None,
    scale_rewards: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rollout log -> (training batch with advantages, per-step metrics in long form).

    R1/J2 buffers as of each step, F9 gate, the configured strategy, R8 merge, V1-V3
    advantages, A1-A7 metrics. Rows of modes that are not cached (eval) are part of the batch
    and of the metrics under their own mode; they are neither replayed nor given replays. The batch is what a trainer reads; write it with
    ``df.write.parquet`` (or ``sources.io.append_rollouts`` for the log itself).
    """
    cols = ["mode", *payload, *([prompt_length] if prompt_length and prompt_length not in payload else [])]

    def scored(part: DataFrame) -> DataFrame:
        return advantages(part.withColumn("reward", weighted_reward(rewards, weights)), mode, scale_rewards=scale_rewards)

    batch = scored(replay_batch(log, cfg, rewards=tuple(rewards), payload=tuple(cols), position=position))
    if cfg.modes:  # groups never mix cached and other modes
        rest = log.filter(~F.coalesce(F.col("mode").isin(*cfg.modes), F.lit(False)))
        only_online = R.ReplayConfig(strategy="none", modes=())
        batch = batch.unionByName(scored(replay_batch(rest, only_online, rewards=tuple(rewards), payload=tuple(cols))))
    metrics = M.to_long(M.step_metrics(batch, rewards, prompt_length=prompt_length))
    return batch, metrics


def replay_to_loss(
    log: DataFrame,
    tokens: DataFrame,
    cfg: ReplayConfig,
    loss_cfg: L.LossConfig,
    *,
    eos: int,
    mask_truncated: bool = False,
    mode: str = "split",
    rewards: Sequence[str] = ("r_accuracy", "r_format"),
    weights: Sequence[float] | None = None,
    position: str | None = None,
    payload: Sequence[str] = ("completion_len", "terminated"),
    prompt_length: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One training step's tables end to end: (batch rows with tokens and masks, all metrics in long form).

    ``tokens`` holds ``rollout_id, completion_ids, logps, old_logps, ref_logps`` and is joined by
    id once the batch is chosen (J6), so token arrays never pass through a buffer. Masks (F4-F6),
    token sums (L1, L2), batch losses (L3-L6) and the loss metrics (L7) follow, per mode and step.
    """
    batch, metrics = replay_step_tables(
        log, cfg, mode=mode, rewards=rewards, weights=weights, position=position, payload=payload, prompt_length=prompt_length
    )
    full = batch.join(tokens, "rollout_id").withColumn("mask_len", TK.masked_length("completion_ids", eos, mask_truncated=mask_truncated))
    group = ("mode", "batch_step")
    sums = L.token_sums(full, loss_cfg, now="logps", old="old_logps", ref="ref_logps")
    losses = L.loss_metrics(L.batch_losses(sums, loss_cfg, group), loss_cfg, group).withColumnRenamed("batch_step", "step")
    return full, metrics.unionByName(losses.withColumn("value", F.col("value").cast("double")))


def replay_increment_tables(
    snapshot: DataFrame | None,
    new_log: DataFrame,
    cfg: ReplayConfig,
    *,
    mode: str = "split",
    rewards: Sequence[str] = ("r_accuracy", "r_format"),
    weights: Sequence[float] | None = None,
    payload: Sequence[str] = ("completion_len", "terminated"),
    scale_rewards: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The new steps of a growing log -> (their training batch with advantages, next snapshot).

    ``snapshot`` is the previous call's second output (None on the first call); write it to
    the shared checkpoint folder between runs. New rows are numbered on from the snapshot, so
    they need no ranking against the history.
    """
    cols = (*rewards, *payload)
    online = new_log.filter(F.col("mode").isin(*cfg.modes)) if cfg.modes else new_log
    new_rows = online.withColumn("score", plain_score(rewards))
    keep = ["prompt_key", "pos", "rollout_id", "seq", "score", *cols]
    if snapshot is None:
        snapshot = new_rows.withColumn("pos", F.lit(0).cast("bigint")).select(*keep).limit(0)
    replays, next_snapshot = R.replay_increment(snapshot.select(*keep), new_rows, cfg, carry=cols)
    on, off = R.merge_parts(online, replays, None, columns=cols)
    reward = weighted_reward(rewards, weights)
    if mode == "split":
        on = advantages(on.withColumn("reward", reward), mode, scale_rewards=scale_rewards)
        off = advantages(off.withColumn("reward", reward), mode, scale_rewards=scale_rewards)
        return on.unionByName(off), next_snapshot
    batch = on.unionByName(off).withColumn("reward", reward)
    return advantages(batch, mode, scale_rewards=scale_rewards), next_snapshot
