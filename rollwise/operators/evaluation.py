"""Evaluation metrics over graded outputs.

Input is the long form: one row per (dataset, problem, sample_idx) with a nullable grade
``flag``. Per-problem partial sums are computed in one aggregation (map-side combined, so
a problem with many samples does not gather in one task), then averaged per dataset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The k list (powers of two up to 256) and the datasets evaluated with 32 samples.
PASS_K = (1, 2, 4, 8, 16, 32, 64, 128, 256)
FIXED_32_DATASETS = ("aime24", "aime25", "amc23")


def samples_rule(dataset: Column | str, num_samples: int) -> Column:
    """32 samples for the fixed datasets, else ``num_samples``."""
    d = F.col(dataset) if isinstance(dataset, str) else dataset
    return F.when(d.isin(*FIXED_32_DATASETS), F.lit(32)).otherwise(F.lit(num_samples))


def _ks(num_samples: int) -> list[int]:
    top = max(32, num_samples)
    return [k for k in PASS_K if k <= top]


def per_problem(graded: DataFrame, num_samples: int, problem: str = "problem") -> DataFrame:
    """Per problem row: ``hit_k`` = any correct among the first k outputs, ``sum_k`` = correct count there.

    ``problem`` names the row id: problems that share a text are counted apart by an id, and a
    row without outputs (NULL ``sample_idx``) counts with nothing correct.
    """
    flag = F.coalesce(F.col("flag"), F.lit(0.0))  # E4: a missing grade counts as wrong
    aggs = []
    for k in _ks(num_samples):
        first_k = F.col("sample_idx") < k
        aggs.append(F.max(F.when(first_k, flag).otherwise(0.0)).alias(f"hit_{k}"))
        aggs.append(F.sum(F.when(first_k, flag).otherwise(0.0)).alias(f"sum_{k}"))
    return graded.groupBy("dataset", problem).agg(*aggs)


def dataset_metrics(graded: DataFrame, datasets: DataFrame, num_samples: int, problem: str = "problem") -> DataFrame:
    """Long form ``(dataset, k, total, pass_at_k, avg_at_k)`` for k <= samples of the dataset.

    ``datasets`` lists every dataset to report (one column ``dataset``); a dataset with no
    surviving problem reports total 0 and every ratio 0. ``problem`` names the column that
    tells result rows apart.
    """
    ks = _ks(num_samples)
    pp = per_problem(graded, num_samples, problem)
    aggs = [F.count(F.lit(1)).alias("total")]
    for k in ks:
        aggs.append(F.sum(F.when(F.col(f"hit_{k}") > 0, 1.0).otherwise(0.0)).alias(f"pass_{k}"))
        aggs.append(F.sum(F.col(f"sum_{k}") / F.lit(float(k))).alias(f"avg_{k}"))
    per_ds = pp.groupBy("dataset").agg(*aggs)
    full = datasets.select(F.col("dataset").alias("_ds")).distinct().join(per_ds, F.col("_ds").eqNullSafe(F.col("dataset")), "left").withColumn("dataset", F.col("_ds"))
    total = F.coalesce(F.col("total"), F.lit(0))
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("k"),
                    F.coalesce(F.try_divide(F.col(f"pass_{k}"), total), F.lit(0.0)).alias("pass_at_k"),
                    F.coalesce(F.try_divide(F.col(f"avg_{k}"), total), F.lit(0.0)).alias("avg_at_k"),
                )
                for k in ks
            ]
        )
    )
    long = full.select("dataset", total.cast("bigint").alias("total"), rows.alias("m"))
    return long.select("dataset", "total", "m.k", "m.pass_at_k", "m.avg_at_k").filter(
        F.col("k") <= samples_rule("dataset", num_samples)
    )


def summary(metrics: DataFrame) -> DataFrame:
    """E5 in the reference's key form: ``(dataset, metric, value)`` with ``total``, ``pass@k``, ``avg@k``."""
    kv = F.explode(
        F.array(
            F.struct(F.concat(F.lit("pass@"), F.col("k").cast("string")).alias("metric"), F.col("pass_at_k").alias("value")),
            F.struct(F.concat(F.lit("avg@"), F.col("k").cast("string")).alias("metric"), F.col("avg_at_k").alias("value")),
        )
    )
    ratios = metrics.select("dataset", kv.alias("kv")).select("dataset", "kv.metric", "kv.value")
    totals = metrics.select("dataset", F.lit("total").alias("metric"), F.col("total").cast("double").alias("value")).distinct()
    return ratios.unionByName(totals)


def length_filter_report(problems: DataFrame, n_tokens: Column, max_tokens: int) -> DataFrame:
    """keep prompts with ``n_tokens <= max_tokens``; count kept and skipped per dataset in one pass.

    A prompt without a count (NULL) is not known to be too long: it is kept, and counted as such.
    """
    skipped = F.coalesce(n_tokens > F.lit(max_tokens), F.lit(False))
    return problems.groupBy("dataset").agg(
        F.count(F.when(~skipped, 1)).alias("kept"), F.count(F.when(skipped, 1)).alias("skipped")
    )

