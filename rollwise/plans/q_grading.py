"""Registered queries for grading and rewards."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from rollwise.functions import grading as GR
from rollwise.operators import evaluation as E
from rollwise.operators.positions import rank_within_key
from rollwise.operators.registry import add_rewards, pandas_reward
from rollwise.plans.fixtures import FMT_SQL, GRADE_SQL, ROLL_SQL, fmt, grade, roll
from rollwise.plans.registry import register


@register("g1_format_reward", f"WITH {FMT_SQL}\nSELECT conv_id, turn, {GR.sql_format_reward('completion')} AS reward FROM fmt")
def g1_format_reward(spark, sf):
    return fmt(spark, sf).select("conv_id", "turn", GR.format_reward("completion").alias("reward"))


_ACC_SQL = f"""WITH {GRADE_SQL},
ex AS (SELECT *, {GR.sql_extract('prediction')} AS p, {GR.sql_extract('gold', gold=True)} AS g FROM grade),
kx AS (SELECT *, {GR.sql_kind('p')} AS pk, {GR.sql_kind('g')} AS gk FROM ex),
vx AS (SELECT *, {GR.sql_elements('p', 'pk')} AS pe, {GR.sql_elements('g', 'gk')} AS ge FROM kx),
graded AS (
  SELECT *, CASE WHEN pk = '' THEN pe[1].v END AS pv, CASE WHEN gk = '' THEN ge[1].v END AS gv,
         CAST(CASE WHEN g IS NULL THEN NULL WHEN p IS NULL THEN 0.0
                   WHEN {GR.sql_equal('pk', 'gk', 'pe', 'ge')} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS reward
  FROM vx)"""


@register("g2_accuracy_reward", f"{_ACC_SQL}\nSELECT p_partkey, reward FROM graded")
def g2_accuracy_reward(spark, sf):
    return GR.with_accuracy(grade(spark, sf), "prediction", "gold").select("p_partkey", "reward")


@register(
    "g2_accuracy_summary",
    f"""{_ACC_SQL}
SELECT p_type AS dataset, count(*) AS n_rows, count(reward) AS n_graded,
       round(avg(reward), 6) AS rate, round(1.0 - count(reward) / count(*), 6) AS null_share
FROM graded GROUP BY p_type""",
)
def g2_accuracy_summary(spark, sf):
    """Graded table per dataset: rate over graded rows and the share with no readable gold."""
    g = GR.with_accuracy(grade(spark, sf), "prediction", "gold")
    return g.groupBy(F.col("p_type").alias("dataset")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("reward").alias("n_graded"),
        F.round(F.avg("reward"), 6).alias("rate"),
        F.round(F.lit(1.0) - F.count("reward") / F.count(F.lit(1)), 6).alias("null_share"),
    )


@register(
    "g4_answer_extract",
    f"{_ACC_SQL}\nSELECT p_partkey, p AS pred_answer, g AS gold_answer, pv AS pred_value, gv AS gold_value FROM graded",
)
def g4_answer_extract(spark, sf):
    g = GR.with_accuracy(grade(spark, sf), "prediction", "gold", keep_parts=True)
    return g.select("p_partkey", "pred_answer", "gold_answer", "pred_value", "gold_value")


@register(
    "g3_eval_grade",
    f"""{_ACC_SQL},
ev AS (SELECT p_type AS dataset, p_brand AS problem, reward AS flag,
              row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_partkey) - 1 AS sample_idx FROM graded),
ks AS (SELECT unnest([1, 2, 4, 8]) AS k),
pp AS (SELECT e.dataset, e.problem, ks.k,
              max(CASE WHEN e.sample_idx < ks.k THEN coalesce(e.flag, 0.0) ELSE 0.0 END) AS hit,
              sum(CASE WHEN e.sample_idx < ks.k THEN coalesce(e.flag, 0.0) ELSE 0.0 END) AS s
       FROM ev e, ks GROUP BY ALL)
SELECT dataset, k, CAST(count(*) AS BIGINT) AS total,
       round(sum(CASE WHEN hit > 0 THEN 1.0 ELSE 0.0 END) / count(*), 6) AS pass_at_k,
       round(sum(s / k) / count(*), 6) AS avg_at_k
FROM pp GROUP BY dataset, k""",
)
def g3_eval_grade(spark, sf):
    """G3 feeding E1/E2: grade every output, then pass@k / avg@k per dataset (8 samples)."""
    g = GR.with_accuracy(grade(spark, sf), "prediction", "gold", "flag").select(
        F.col("p_type").alias("dataset"), F.col("p_brand").alias("problem"), "p_partkey", "flag"
    )
    ev = rank_within_key(g, ["dataset", "problem"], "p_partkey", out="sample_idx")
    datasets = g.select("dataset")
    m = E.dataset_metrics(ev, datasets, 8)
    return m.select("dataset", "k", "total", F.round("pass_at_k", 6).alias("pass_at_k"), F.round("avg_at_k", 6).alias("avg_at_k"))


@register(
    "g6_named_rewards",
    f"""WITH {GRADE_SQL.replace('grade AS', 'grade0 AS')},
grade AS (SELECT p_partkey, p_type, p_brand, gold, prediction FROM grade0),
{_ACC_SQL[len('WITH ' + GRADE_SQL) + 2:]}
SELECT p_partkey, {GR.sql_format_reward('prediction')} AS r_format, reward AS r_accuracy FROM graded""",
)
def g6_named_rewards(spark, sf):
    """G5/G6 through the registry: ``format_accuracy`` → one nullable column per function."""
    g = grade(spark, sf).select("p_partkey", "prediction", "gold")
    return add_rewards(g, "format_accuracy", completion="prediction", gold="gold").select(
        "p_partkey", "r_format", "r_accuracy"
    )


def _length_reward(completion: pd.Series, accuracy: pd.Series) -> pd.Series:
    """Example custom reward: 1.0 for completions longer than 5 characters; missing when the
    accuracy reward is missing."""
    out = (completion.str.len() > 5).astype("float64")
    return out.where(accuracy.notna())


@register(
    "d1_custom_reward",
    f"""WITH {ROLL_SQL}
SELECT rollout_id, CAST(CASE WHEN r_accuracy IS NULL THEN NULL WHEN length(completion) > 5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS r_length
FROM roll""",
)
def d1_custom_reward(spark, sf):
    udf = pandas_reward(_length_reward)
    return roll(spark, sf).select("rollout_id", udf("completion", "r_accuracy").alias("r_length"))
