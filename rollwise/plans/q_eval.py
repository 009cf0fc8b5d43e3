"""Registered queries for the evaluation path."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.functions.text import (
    DEFAULT_EOS,
    GENERATION_PROMPT,
    PROMPTS,
    PY_WHITESPACE,
    fill_template,
    render_chat,
    sql_word_count,
    trim_ws,
    word_count,
)
from rollwise.operators import evaluation as E
from rollwise.plans.fixtures import EVAL_SQL, eval_rows, sql_lit
from rollwise.plans.registry import register
from rollwise.sources.tables import read_table

N_SAMPLES = 8
KS_SQL = "SELECT unnest([1, 2, 4, 8, 16, 32]) AS k"
NS_SQL = f"CASE WHEN dataset IN ('aime24', 'aime25', 'amc23') THEN 32 ELSE {N_SAMPLES} END"


def _datasets(spark, sf):
    return read_table(spark, sf, "documents").select(F.col("lang").alias("dataset"))


def _metrics(spark, sf):
    return E.dataset_metrics(eval_rows(spark, sf), _datasets(spark, sf), N_SAMPLES)


_METRICS_SQL = f"""WITH {EVAL_SQL},
ks AS ({KS_SQL}),
pp AS (
  SELECT e.dataset, e.problem, ks.k,
         max(CASE WHEN e.sample_idx < ks.k THEN coalesce(e.flag, 0.0) ELSE 0.0 END) AS hit,
         sum(CASE WHEN e.sample_idx < ks.k THEN coalesce(e.flag, 0.0) ELSE 0.0 END) AS s
  FROM ev e, ks GROUP BY ALL),
pd AS (
  SELECT dataset, k, count(*) AS total, sum(CASE WHEN hit > 0 THEN 1.0 ELSE 0.0 END) AS p, sum(s / k) AS a
  FROM pp GROUP BY ALL),
ds AS (SELECT DISTINCT lang AS dataset FROM documents),
m AS (
  SELECT ds.dataset, ks.k, coalesce(pd.total, 0) AS total,
         coalesce(pd.p / pd.total, 0.0) AS pass_at_k, coalesce(pd.a / pd.total, 0.0) AS avg_at_k
  FROM ds CROSS JOIN ks LEFT JOIN pd ON pd.dataset = ds.dataset AND pd.k = ks.k
  WHERE ks.k <= {NS_SQL.replace("dataset", "ds.dataset")})"""


@register("e1_pass_at_k", f"{_METRICS_SQL}\nSELECT dataset, k, round(pass_at_k, 6) AS pass_at_k FROM m")
def e1_pass_at_k(spark, sf):
    return _metrics(spark, sf).select("dataset", "k", F.round("pass_at_k", 6).alias("pass_at_k"))


@register("e2_avg_at_k", f"{_METRICS_SQL}\nSELECT dataset, k, round(avg_at_k, 6) AS avg_at_k FROM m")
def e2_avg_at_k(spark, sf):
    return _metrics(spark, sf).select("dataset", "k", F.round("avg_at_k", 6).alias("avg_at_k"))


@register("e3_totals", f"{_METRICS_SQL}\nSELECT DISTINCT dataset, CAST(total AS BIGINT) AS total FROM m")
def e3_totals(spark, sf):
    return _metrics(spark, sf).select("dataset", "total").distinct()


_RESULTS_SQL = """res AS (SELECT d.doc_id AS problem_id, d.lang AS dataset, d.doc_id % 3 AS n_out, CAST(l.quality AS DOUBLE) AS q
  FROM documents d LEFT JOIN labels l USING (doc_id)),
ks AS (SELECT unnest([1, 2, 4, 8]) AS k),
pk AS (SELECT r.*, ks.k, least(ks.k, n_out) AS n FROM res r, ks),
pr AS (SELECT dataset, k, problem_id, (CASE WHEN n >= 1 THEN coalesce(q, 0.0) ELSE 0.0 END) + (CASE WHEN n >= 2 THEN coalesce(1 - q, 0.0) ELSE 0.0 END) AS s,
  greatest(CASE WHEN n >= 1 THEN coalesce(q, 0.0) ELSE 0.0 END, CASE WHEN n >= 2 THEN coalesce(1 - q, 0.0) ELSE 0.0 END) AS hit FROM pk)"""


@register(
    "e3_duplicate_problems",
    f"""WITH {_RESULTS_SQL}
SELECT dataset, k, CAST(count(*) AS BIGINT) AS total, round(sum(CASE WHEN hit > 0 THEN 1.0 ELSE 0.0 END) / count(*), 6) AS pass_at_k,
       round(sum(s / k) / count(*), 6) AS avg_at_k FROM pr GROUP BY dataset, k""",
)
def e3_duplicate_problems(spark, sf):
    """Result rows that share their problem text, some without outputs: each row is a problem of its own."""
    docs = read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("problem_id"), F.col("lang").alias("dataset"), F.col("source").alias("problem")
    )
    labels = read_table(spark, sf, "labels").select(F.col("doc_id").alias("problem_id"), F.col("quality").cast("double").alias("q"))
    rows = docs.join(labels, "problem_id", "left").withColumn(
        "grades", F.slice(F.array("q", 1 - F.col("q")), F.lit(1), (F.col("problem_id") % 3).cast("int"))
    )
    graded = rows.select("dataset", "problem_id", F.posexplode_outer("grades").alias("sample_idx", "flag"))
    out = E.dataset_metrics(graded, rows.select("dataset"), N_SAMPLES, problem="problem_id")
    return out.select("dataset", "k", "total", F.round("pass_at_k", 6).alias("pass_at_k"), F.round("avg_at_k", 6).alias("avg_at_k"))


@register(
    "e5_eval_summary",
    f"""{_METRICS_SQL}
SELECT dataset, 'pass@' || k AS metric, round(pass_at_k, 6) AS value FROM m
UNION ALL SELECT dataset, 'avg@' || k, round(avg_at_k, 6) FROM m
UNION ALL SELECT DISTINCT dataset, 'total', CAST(total AS DOUBLE) FROM m""",
)
def e5_eval_summary(spark, sf):
    s = E.summary(_metrics(spark, sf))
    return s.select("dataset", "metric", F.round("value", 6).alias("value"))


@register(
    "e4_missing_grade",
    f"""WITH {EVAL_SQL}
SELECT dataset, count(*) AS n_outputs, count(*) FILTER (WHERE flag IS NULL) AS n_ungraded,
       sum(coalesce(flag, 0.0)) AS n_correct FROM ev GROUP BY dataset""",
)
def e4_missing_grade(spark, sf):
    ev = eval_rows(spark, sf)
    return ev.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_outputs"),
        F.count(F.when(F.col("flag").isNull(), 1)).alias("n_ungraded"),
        F.sum(F.coalesce("flag", F.lit(0.0))).alias("n_correct"),
    )


@register(
    "j5_grade_join",
    f"""WITH {EVAL_SQL}
SELECT doc_id, dataset, problem, sample_idx, coalesce(flag, 0.0) AS flag FROM ev""",
)
def j5_grade_join(spark, sf):
    ev = eval_rows(spark, sf)
    return ev.select("doc_id", "dataset", "problem", "sample_idx", F.coalesce("flag", F.lit(0.0)).alias("flag"))


@register(
    "j4_problem_outputs",
    f"""WITH {EVAL_SQL},
problems AS (SELECT lang AS dataset, source AS problem, md5(lang || '/' || source) AS problem_id, count(*) AS n_outputs
             FROM documents GROUP BY ALL)
SELECT p.problem_id, p.dataset, p.n_outputs, e.sample_idx, e.doc_id
FROM problems p JOIN ev e ON e.dataset = p.dataset AND e.problem = p.problem""",
)
def j4_problem_outputs(spark, sf):
    problems = (
        read_table(spark, sf, "documents")
        .groupBy(F.col("lang").alias("dataset"), F.col("source").alias("problem"))
        .agg(F.count(F.lit(1)).alias("n_outputs"))
        .withColumn("problem_id", F.md5(F.concat_ws("/", "dataset", "problem")))
    )
    ev = eval_rows(spark, sf)
    return problems.join(ev, ["dataset", "problem"]).select("problem_id", "dataset", "n_outputs", "sample_idx", "doc_id")


_WS_SQL = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


@register(
    "p8_trim_outputs",
    f"""SELECT doc_id, CAST(length(trim(text, {_WS_SQL})) AS BIGINT) AS trimmed_len,
       CAST(length(text) AS BIGINT) AS raw_len, md5(trim(text, {_WS_SQL})) AS trimmed_md5 FROM documents""",
)
def p8_trim_outputs(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    t = trim_ws("text")
    return d.select(
        "doc_id",
        F.length(t).cast("bigint").alias("trimmed_len"),
        F.length("text").cast("bigint").alias("raw_len"),
        F.md5(t).alias("trimmed_md5"),
    )


@register("p9_samples_rule", f"SELECT DISTINCT lang AS dataset, {NS_SQL.replace('dataset', 'lang')} AS n_samples FROM documents")
def p9_samples_rule(spark, sf):
    d = _datasets(spark, sf).distinct()
    return d.select("dataset", E.samples_rule("dataset", N_SAMPLES).alias("n_samples"))


@register(
    "p10_explode_outputs",
    f"""SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS sample_idx,
       CAST(length(trim(unnest(arr), {_WS_SQL})) AS BIGINT) AS output_len
FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents)""",
)
def p10_explode_outputs(spark, sf):
    """P10 + P8: a row's output array (here: a document's lines) to one row per output, trimmed.

    The array is the row's own column, so nothing is gathered across rows.
    """
    d = read_table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("outputs"))
    long = d.select("doc_id", F.posexplode("outputs").alias("sample_idx", "output"))
    return long.select(
        "doc_id", F.col("sample_idx").cast("bigint").alias("sample_idx"), F.length(trim_ws("output")).cast("bigint").alias("output_len")
    )


_PREFIX = PROMPTS["RL_ZERO"][0]
_RENDER_SQL = (
    f"'<|user|>' || chr(10) || {sql_lit(_PREFIX)} || text || {sql_lit(DEFAULT_EOS + chr(10))} || {sql_lit(GENERATION_PROMPT)}"
)


@register(
    "f2_prompt_length_filter",
    f"""SELECT lang AS dataset,
       count(*) FILTER (WHERE {sql_word_count('(' + _RENDER_SQL + ')')} <= 1500) AS kept,
       count(*) FILTER (WHERE {sql_word_count('(' + _RENDER_SQL + ')')} > 1500) AS skipped
FROM documents GROUP BY lang""",
)
def f2_prompt_length_filter(spark, sf):
    d = read_table(spark, sf, "documents").select(F.col("lang").alias("dataset"), "text")
    msgs = F.array(F.struct(F.lit("user").alias("role"), fill_template("text", "RL_ZERO").alias("content")))
    rendered = render_chat(msgs, add_generation_prompt=True)
    return E.length_filter_report(d, word_count(rendered), 1500)


@register(
    "p3_template_fill",
    f"""SELECT item_id, {sql_lit(_PREFIX)} || text AS prompt_text FROM benchmark
UNION ALL SELECT -1 - item_id, text FROM benchmark""",
)
def p3_template_fill(spark, sf):
    b = read_table(spark, sf, "benchmark")
    with_t = b.select("item_id", fill_template("text", "RL_ZERO").alias("prompt_text"))
    raw = b.select((F.lit(-1) - F.col("item_id")).alias("item_id"), fill_template("text", None).alias("prompt_text"))
    return with_t.unionByName(raw)
