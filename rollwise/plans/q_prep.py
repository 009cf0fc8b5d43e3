"""Registered queries for the preparation path."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.functions.text import DEFAULT_EOS, PY_WHITESPACE, prompt_key, render_chat, sql_word_count, word_count
from rollwise.operators import benchmarks as N
from rollwise.operators import prep as P
from rollwise.plans.fixtures import ROLL_SQL, bench_sources, conv, raw_training, roll, sql_lit
from rollwise.plans.registry import register
from rollwise.sources.tables import read_table

EOS_NL = sql_lit(DEFAULT_EOS + "\n")
RENDER_TURN = (
    "CASE WHEN role IN ('user', 'system', 'assistant') THEN '<|' || role || '|>' || chr(10) || text || "
    f"{EOS_NL} END"
)
CT_SQL = """ct AS (
  SELECT *, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last_a
  FROM conversations)"""
IN_PROMPT = "(last_a IS NULL OR turn < last_a)"
WS_SQL = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


@register(
    "p6_message_assembly",
    f"""SELECT conv_id, CAST(count(*) AS BIGINT) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       coalesce(string_agg({RENDER_TURN}, '' ORDER BY turn), '') AS rendered
FROM conversations GROUP BY conv_id""",
)
def p6_message_assembly(spark, sf):
    c = conv(spark, sf)
    return c.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        render_chat("messages").alias("rendered"),
    )


# A bound that most conversations of the table pass.
_RUN_BYTES = 512
_RUNS_SQL = f"""WITH sized AS (
  SELECT *, coalesce(strlen(role), 0) + coalesce(strlen(text), 0) AS size FROM conversations),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         sum(size) OVER (PARTITION BY conv_id) AS total
  FROM sized)
SELECT conv_id, CAST(start // {_RUN_BYTES} AS BIGINT) AS run, CAST(count(*) AS BIGINT) AS n_messages, CAST(max(total) AS BIGINT) AS total_bytes,
       coalesce(string_agg(role || ':' || text, chr(10) ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST), '') AS rendered
FROM placed GROUP BY conv_id, start // {_RUN_BYTES}"""


@register("p6_message_runs", _RUNS_SQL)
def p6_message_runs(spark, sf):
    """Long conversations as runs of bounded size, the overflow beside the records."""
    runs = P.message_runs(read_table(spark, sf, "conversations"), max_bytes=_RUN_BYTES, n_ranges=4)
    lines = F.filter(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), lambda x: x.isNotNull())
    return runs.select("conv_id", "run", F.size("messages").cast("bigint").alias("n_messages"), "total_bytes", F.array_join(lines, "\n").alias("rendered"))


_P4_SQL = f"""WITH {CT_SQL}
SELECT conv_id,
       coalesce(string_agg({RENDER_TURN}, '' ORDER BY turn) FILTER (WHERE {IN_PROMPT}), '') ||
       CASE WHEN count(*) FILTER (WHERE {IN_PROMPT}) > 0 THEN '<|assistant|>' || chr(10) ELSE '' END AS rendered
FROM ct GROUP BY conv_id"""


@register("p4_chat_render", _P4_SQL)
def p4_chat_render(spark, sf):
    c = conv(spark, sf)
    return c.select("conv_id", render_chat("prompt", add_generation_prompt=True).alias("rendered"))


@register("p5_prompt_key", f"SELECT conv_id, sha256(rendered) AS prompt_key FROM ({_P4_SQL})")
def p5_prompt_key(spark, sf):
    c = conv(spark, sf)
    return c.select("conv_id", prompt_key(render_chat("prompt", add_generation_prompt=True)).alias("prompt_key"))


@register(
    "p7_assistant_prefix",
    """WITH rk AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rk,
         count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
agg AS (
  SELECT conv_id, n, max(CASE WHEN rk = 1 THEN text END) AS last_text,
         max(CASE WHEN rk = 2 THEN role END) AS prev_role, max(CASE WHEN rk = 2 THEN text END) AS prev_text
  FROM rk GROUP BY conv_id, n)
SELECT conv_id, CAST(CASE WHEN prev_role = 'assistant' THEN n - 2 ELSE n - 1 END AS BIGINT) AS n_prompt,
       CASE WHEN prev_role = 'assistant' THEN prev_text || last_text ELSE last_text END AS completion
FROM agg""",
)
def p7_assistant_prefix(spark, sf):
    """Prompt = every message but the last, completion = the last message's content."""
    c = conv(spark, sf).select(
        "conv_id",
        F.slice("messages", 1, F.size("messages") - 1).alias("prompt"),
        F.element_at("messages", -1)["content"].alias("completion"),
    )
    p, comp = P.assistant_prefix("prompt", "completion")
    return c.select("conv_id", F.size(p).cast("bigint").alias("n_prompt"), comp.alias("completion"))


_RAW_SQL = f"""{CT_SQL},
raw AS (
  SELECT conv_id, max(CASE WHEN rn = 1 THEN text END) AS question, max(CASE WHEN turn = last_a THEN text END) AS solution
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM ct)
  GROUP BY conv_id HAVING max(last_a) IS NOT NULL)"""


@register(
    "p1_training_projection",
    f"""WITH {_RAW_SQL}
SELECT conv_id, question AS prompt_text,
       '<|user|>' || chr(10) || question || {EOS_NL} || '<|assistant|>' || chr(10) || solution || {EOS_NL} AS messages_rendered,
       solution, regexp_extract(solution, '(\\S+)\\s*$', 1) AS ground_truth
FROM raw""",
)
def p1_training_projection(spark, sf):
    """P1 with P2's allow-list: only the four training columns (plus the id) survive."""
    t = P.training_projection(raw_training(spark, sf), keep=("conv_id", *P.TRAINING_COLUMNS))
    return t.select(
        "conv_id",
        F.element_at("prompt", 1)["content"].alias("prompt_text"),
        render_chat("messages").alias("messages_rendered"),
        "solution",
        "ground_truth",
    )


@register(
    "p2_keep_columns",
    f"""WITH {_RAW_SQL}
SELECT conv_id, solution, regexp_extract(solution, '(\\S+)\\s*$', 1) AS ground_truth FROM raw""",
)
def p2_keep_columns(spark, sf):
    """P2 on its own: an allow-list that drops the message arrays (and the raw columns)."""
    return P.training_projection(raw_training(spark, sf), keep=("conv_id", "solution", "ground_truth"))


@register(
    "f1_length_filter",
    f"""WITH r AS (SELECT conv_id, coalesce(string_agg({RENDER_TURN}, '' ORDER BY turn), '') AS rendered
               FROM conversations GROUP BY conv_id)
SELECT conv_id, {sql_word_count('rendered')} AS n_tokens FROM r WHERE {sql_word_count('rendered')} < 200""",
)
def f1_length_filter(spark, sf):
    c = conv(spark, sf).withColumn("n_tokens", word_count(render_chat("messages")))
    return P.length_filter(c, F.col("n_tokens"), 200).select("conv_id", "n_tokens")


def _customers(spark, sf):
    cust = read_table(spark, sf, "customer")
    split = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("test")).otherwise(F.lit("train"))
    return cust.select("c_custkey", split.alias("split"))


def _t1_sql(n: int) -> str:
    return f"""SELECT * FROM (SELECT c_custkey, 'train' AS split FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
                ORDER BY md5('42:' || c_custkey), c_custkey LIMIT {n})
UNION ALL SELECT c_custkey, 'test' AS split FROM customer WHERE c_mktsegment = 'HOUSEHOLD'"""


@register("t1_seeded_sample", _t1_sql(100))
def t1_seeded_sample(spark, sf):
    return P.seeded_sample(_customers(spark, sf), "c_custkey", 100, seed=42)


@register("t1_seeded_sample_large", _t1_sql(700))
def t1_seeded_sample_large(spark, sf):
    """A larger sample of the same order."""
    return P.seeded_sample(_customers(spark, sf), "c_custkey", 700, seed=42)


@register(
    "t1_null_split",
    """WITH c AS (SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'test' WHEN 'MACHINERY' THEN NULL ELSE 'train' END AS split,
                  CASE WHEN c_custkey % 50 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS k FROM customer)
SELECT * FROM (SELECT c_custkey, split FROM c WHERE split = 'train' ORDER BY md5('42:' || coalesce(k, '')), k NULLS FIRST, c_custkey LIMIT 60)
UNION ALL SELECT c_custkey, split FROM c WHERE split IS DISTINCT FROM 'train'""",
)
def t1_null_split(spark, sf):
    """Rows without a split pass through; rows without a key have their place in the order."""
    split = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "test").when(F.col("c_mktsegment") != "MACHINERY", "train")
    key = F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey").cast("string"))
    rows = read_table(spark, sf, "customer").select("c_custkey", split.alias("split"), key.alias("k"))
    return P.seeded_sample(rows, "k", 60, seed=42, tie="c_custkey").drop("k")


@register(
    "a9_split_sizes",
    f"SELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM ({_t1_sql(100)}) GROUP BY split",
)
def a9_split_sizes(spark, sf):
    return P.split_sizes(P.seeded_sample(_customers(spark, sf), "c_custkey", 100, seed=42))


@register(
    "t2_first_n",
    f"""WITH {_RAW_SQL}
SELECT conv_id, solution FROM raw ORDER BY conv_id LIMIT 50""",
)
def t2_first_n(spark, sf):
    t = P.training_projection(raw_training(spark, sf), keep=("conv_id", *P.TRAINING_COLUMNS))
    return P.first_n(t, "conv_id", 50).select("conv_id", "solution")


@register(
    "u3_unique_prompts",
    f"""WITH {ROLL_SQL}
SELECT prompt_key, min(seq) AS seq, arg_min(completion, seq) AS completion FROM roll GROUP BY prompt_key""",
)
def u3_unique_prompts(spark, sf):
    return P.first_per_key(roll(spark, sf), "prompt_key", "seq", ["completion"])


# ----------------------------------------------------------------------------- benchmarks

_T = "trim({x}, " + WS_SQL + ")"


def _trim(x: str) -> str:
    return _T.replace("{x}", x)


_MARK = "'####\\s*([^\\n]+)'"
_BENCH_SQL = {
    "gsm8k": f"""SELECT 'gsm8k' AS dataset, question AS problem,
         CASE WHEN regexp_matches(answer, {_MARK}) THEN {_trim(f"regexp_extract(answer, {_MARK}, 1)")}
              ELSE {_trim("answer")} END AS answer
  FROM (SELECT text AS question, CASE WHEN item_id % 4 = 3 THEN text
               ELSE text || chr(10) || '#### ' || CAST(item_id AS VARCHAR) END AS answer FROM benchmark)""",
    "olympiadbench": f"""SELECT 'olympiadbench' AS dataset, array_to_string(solution, ' ') AS problem,
         coalesce({_trim("final_answer[1]")}, '') AS answer
  FROM (SELECT [text, CAST(item_id AS VARCHAR)] AS solution,
               CASE WHEN item_id % 5 = 0 THEN []::VARCHAR[] ELSE [' ' || CAST(item_id AS VARCHAR) || ' '] END AS final_answer
        FROM benchmark)""",
    "math500": f"""SELECT 'math500' AS dataset, text AS problem, {_trim("chr(10) || CAST(item_id AS VARCHAR) || ' '")} AS answer
  FROM benchmark""",
    "aime24": f"""SELECT 'aime24' AS dataset, text AS problem, {_trim("CAST(item_id AS VARCHAR)")} AS answer FROM benchmark""",
}


def _norm_query(alias):
    def q(spark, sf):
        return N.normalize(bench_sources(spark, sf)[alias], alias)

    return q


for _name, _alias in {
    "n1_marker_answer": "gsm8k",
    "n2_list_answer": "olympiadbench",
    "n3_default_answer": "math500",
    "n3_question_fallback": "aime24",
}.items():
    register(_name, _BENCH_SQL[_alias])(_norm_query(_alias))


_UNION_SQL = "\nUNION ALL\n".join(f"SELECT * FROM ({s})" for s in _BENCH_SQL.values())


def _combined(spark, sf):
    return N.union_benchmarks(N.normalize(df, alias) for alias, df in bench_sources(spark, sf).items())


@register("u1_union_benchmarks", _UNION_SQL)
def u1_union_benchmarks(spark, sf):
    return _combined(spark, sf)


@register("u2_distinct_aliases", f"SELECT DISTINCT dataset FROM ({_UNION_SQL})")
def u2_distinct_aliases(spark, sf):
    return N.aliases(_combined(spark, sf))


@register(
    "n4_alias_counts",
    f"SELECT dataset, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE answer = '') AS BIGINT) AS n_empty FROM ({_UNION_SQL}) GROUP BY dataset",
)
def n4_alias_counts(spark, sf):
    """N4 tags + A9 per-alias counts."""
    return _combined(spark, sf).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("answer") == "", 1)).alias("n_empty")
    )
