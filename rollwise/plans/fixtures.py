"""Rollout-shaped tables derived from the driver's input tables (FIXTURES.md section 4).

These are the inputs the registered queries run on. Each is a lazy plan over the full
input table, so its work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.operators.positions import rank_within_key
from rollwise.sources.tables import read_table

G = 8
REWARDS = ("r_accuracy", "r_format")


def roll(spark: SparkSession, sf_dir: str, *, group_size: int = G, n_ranges: int | None = None) -> DataFrame:
    """``roll``: events as a rollout log.

    prompt = user; append order = event_id (it follows ts throughout); each run of
    ``group_size`` consecutive events of a user is one visit (= step); the last visit of a user
    may be short. ``fifo`` is the row's append number within its prompt.
    accuracy is 1 for purchase/signup, missing for error, else 0; format is value > 50.
    """
    ev = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("prompt_key"),
        F.col("event_id").alias("rollout_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("completion"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit(1.0))
        .when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .otherwise(F.lit(0.0))
        .alias("r_accuracy"),
        F.when(F.col("value") > 50, F.lit(1.0)).otherwise(F.lit(0.0)).alias("r_format"),
        (F.get_json_object("props", "$.k").try_cast("int") + F.lit(1)).alias("completion_len"),
        (F.col("user_id") % 7 + F.lit(3)).cast("int").alias("prompt_len"),
        (F.col("event_type") != "view").alias("terminated"),
    )
    ranked = rank_within_key(ev, ["prompt_key"], "seq", out="fifo", n_ranges=n_ranges)
    g = F.lit(group_size)
    return (
        ranked.withColumn("step", F.floor(F.col("fifo") / g).cast("bigint"))
        .withColumn("visit", F.col("step"))
        .withColumn("slot", (F.col("fifo") % g).cast("int"))
        .withColumn("block", F.lit(0))
        .withColumn("mode", F.lit("train"))
    )


ROLL_SQL = """
roll AS (
  SELECT *, CAST(fifo // 8 AS BIGINT) AS step, CAST(fifo // 8 AS BIGINT) AS visit, CAST(fifo % 8 AS INTEGER) AS slot,
         0 AS block, 'train' AS mode
  FROM (
    SELECT user_id AS prompt_key, event_id AS rollout_id, event_id AS seq, event_type AS completion,
           CASE WHEN event_type IN ('purchase', 'signup') THEN 1.0
                WHEN event_type = 'error' THEN NULL ELSE 0.0 END::DOUBLE AS r_accuracy,
           CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END::DOUBLE AS r_format,
           CAST(props->>'$.k' AS INTEGER) + 1 AS completion_len,
           CAST(user_id % 7 + 3 AS INTEGER) AS prompt_len,
           event_type <> 'view' AS terminated,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS fifo
    FROM events)
)"""


def eval_rows(spark: SparkSession, sf_dir: str, *, n_ranges: int | None = None) -> DataFrame:
    """``eval``: graded outputs in long form.

    dataset = lang; problem = source; each document is one output of its problem,
    ``sample_idx`` = its rank by doc_id; the grade is the label's quality, missing when
    the document has no label (J5: left join).
    """
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("lang").alias("dataset"), F.col("source").alias("problem"), "doc_id", F.col("text").alias("output")
    )
    # rank before the join: the rank's count pass then reads only the documents' key columns
    ranked = rank_within_key(docs, ["dataset", "problem"], "doc_id", out="sample_idx", n_ranges=n_ranges)
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("flag"))
    return ranked.join(labels, "doc_id", "left")


EVAL_SQL = """
ev AS (
  SELECT d.lang AS dataset, d.source AS problem, d.doc_id, d.text AS output, CAST(l.quality AS DOUBLE) AS flag,
         row_number() OVER (PARTITION BY d.lang, d.source ORDER BY d.doc_id) - 1 AS sample_idx
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""


def sql_lit(s: str) -> str:
    """A DuckDB expression for an arbitrary Python string (control characters via chr)."""
    parts, buf = [], []
    for ch in s:
        if ch.isprintable() and ch != "'":
            buf.append(ch)
        elif ch == "'":
            buf.append("''")
        else:
            if buf:
                parts.append("'" + "".join(buf) + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
    if buf or not parts:
        parts.append("'" + "".join(buf) + "'")
    return "(" + " || ".join(parts) + ")"


def conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv``: conversations as message arrays, cut at the last assistant turn."""
    from rollwise.operators.prep import assemble_messages, split_at_last_assistant

    turns = read_table(spark, sf_dir, "conversations")
    return split_at_last_assistant(assemble_messages(turns))


def raw_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw training rows from ``conv``: question = first message, solution = last assistant
    turn, final answer = the solution's last whitespace-free run. Rows without a solution
    are not training rows."""
    c = conv(spark, sf_dir).filter(F.col("solution").isNotNull())
    return c.select(
        "conv_id",
        F.element_at("messages", 1)["content"].alias("question"),
        F.col("solution").alias("r1_solution_1"),
        F.regexp_extract("solution", r"(\S+)\s*$", 1).alias("final_answer"),
    )


def bench_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Four raw benchmark sources from ``benchmark``, one per normalisation case."""
    b = read_table(spark, sf_dir, "benchmark")
    iid = F.col("item_id").cast("string")
    return {
        "gsm8k": b.select(
            F.col("text").alias("question"),
            F.when(F.col("item_id") % 4 == 3, F.col("text"))
            .otherwise(F.concat(F.col("text"), F.lit("\n#### "), iid))
            .alias("answer"),
        ),
        "olympiadbench": b.select(
            F.array(F.col("text"), iid).alias("solution"),
            F.when(F.col("item_id") % 5 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(F.concat(F.lit(" "), iid, F.lit(" "))))
            .alias("final_answer"),
        ),
        "math500": b.select(F.col("text").alias("problem"), F.concat(F.lit("\n"), iid, F.lit(" ")).alias("answer")),
        "aime24": b.select(F.col("text").alias("question"), iid.alias("answer")),
    }


def _neg_abs(col: str = "embedding"):
    return F.transform(col, lambda x: -F.abs(x.cast("double")))


def tok(spark: SparkSession, sf_dir: str, *, batch_rows: int = 50) -> DataFrame:
    """``tok``: stored log-probs per completion token.

    logp_now = -|e|, logp_old = -|e| of the previous vec_id, ref = of the one before
    (cyclic); mask length = 1 + vec_id mod 64; fresh when the label is odd;
    advantage = (label - 4.5) / 4.5; batch = vec_id div ``batch_rows``.
    """
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", _neg_abs().alias("nl"))
    n = emb.select(F.max("vec_id") + F.lit(1)).scalar()  # a scalar subquery, evaluated once in the plan
    old = emb.select(((F.col("vec_id") + 1) % n).alias("vec_id"), F.col("nl").alias("logp_old"))
    ref = emb.select(((F.col("vec_id") + 2) % n).alias("vec_id"), F.col("nl").alias("ref_logp"))
    return (
        emb.join(old, "vec_id")
        .join(ref, "vec_id")
        .select(
            "vec_id",
            F.floor(F.col("vec_id") / batch_rows).cast("bigint").alias("batch"),
            F.col("nl").alias("logp_now"),
            "logp_old",
            "ref_logp",
            (F.lit(1) + F.col("vec_id") % 64).cast("int").alias("mask_len"),
            (F.col("label") % 2).alias("is_online"),
            ((F.col("label") - 4.5) / 4.5).alias("advantage"),
        )
    )


TOK_SQL = """
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: -abs(CAST(x AS DOUBLE))) AS nl FROM embeddings),
nn AS (SELECT max(vec_id) + 1 AS n FROM embeddings),
tok AS (
  SELECT c.vec_id, c.vec_id // 50 AS batch, c.nl AS now_, p1.nl AS old_, p2.nl AS ref_,
         CAST(1 + c.vec_id % 64 AS INTEGER) AS n, c.label % 2 AS is_online, (c.label - 4.5) / 4.5 AS adv
  FROM e c CROSS JOIN nn
  JOIN e p1 ON p1.vec_id = (c.vec_id - 1 + nn.n) % nn.n
  JOIN e p2 ON p2.vec_id = (c.vec_id - 2 + nn.n) % nn.n)"""


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ids``: token ids floor(|e| * 50) (EOS = 0); prompt = the first 1 + vec_id mod 16 ids,
    completion = all the others."""
    emb = read_table(spark, sf_dir, "embeddings")
    t = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 50).cast("int"))
    return emb.select(
        "vec_id",
        F.slice(t, 1, F.lit(1) + F.col("vec_id") % 16).alias("prompt_ids"),
        F.slice(t, F.lit(2) + F.col("vec_id") % 16, F.size("embedding")).alias("completion_ids"),
    )


IDS_SQL = """
ids AS (
  SELECT vec_id, list_slice(t, 1, 1 + vec_id % 16) AS prompt_ids, list_slice(t, 2 + vec_id % 16, len(t)) AS completion_ids
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 50) AS INTEGER)) AS t
        FROM embeddings))"""


def grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``grade``: gold ``\\boxed{p_size}`` (a fraction form when p_partkey mod 7 = 0, empty when
    mod 11 = 0); the prediction is an equation ``x = p_size`` when p_partkey mod 13 = 0, a
    number with a unit when mod 17 = 0, else by
    p_partkey mod 5: same boxed / boxed p_size+1 / boxed ``p_size.0`` / ``final answer is
    $p_size$`` / no answer."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    size = F.col("p_size").cast("string")
    key = F.col("p_partkey")
    gold = (
        F.when(key % 11 == 0, F.lit(""))
        .when(key % 7 == 0, F.concat(F.lit("\\boxed{\\frac{"), size, F.lit("}{1}}")))
        .otherwise(F.concat(F.lit("\\boxed{"), size, F.lit("}")))
    )
    m = key % 5
    pred = (
        F.when(key % 13 == 0, F.concat(F.lit("so \\boxed{x = "), size, F.lit("}")))
        .when(key % 17 == 0, F.concat(F.lit("\\boxed{"), size, F.lit("\\text{ cm}}")))
        .when(m == 0, F.concat(F.lit("The result is \\boxed{"), size, F.lit("}.")))
        .when(m == 1, F.concat(F.lit("\\boxed{"), (F.col("p_size") + 1).cast("string"), F.lit("}")))
        .when(m == 2, F.concat(F.lit("so \\boxed{"), size, F.lit(".0}")))
        .when(m == 3, F.concat(F.lit("Therefore the final answer is $"), size, F.lit("$.")))
        .otherwise(F.lit("I could not solve it."))
    )
    return p.select("p_partkey", "p_type", "p_brand", gold.alias("gold"), pred.alias("prediction"))


GRADE_SQL = r"""
grade AS (
  SELECT p_partkey, p_type, p_brand,
         CASE WHEN p_partkey % 11 = 0 THEN ''
              WHEN p_partkey % 7 = 0 THEN '\boxed{\frac{' || CAST(p_size AS VARCHAR) || '}{1}}'
              ELSE '\boxed{' || CAST(p_size AS VARCHAR) || '}' END AS gold,
         CASE WHEN p_partkey % 13 = 0 THEN 'so \boxed{x = ' || CAST(p_size AS VARCHAR) || '}'
              WHEN p_partkey % 17 = 0 THEN '\boxed{' || CAST(p_size AS VARCHAR) || '\text{ cm}}' ELSE
         CASE p_partkey % 5
              WHEN 0 THEN 'The result is \boxed{' || CAST(p_size AS VARCHAR) || '}.'
              WHEN 1 THEN '\boxed{' || CAST(p_size + 1 AS VARCHAR) || '}'
              WHEN 2 THEN 'so \boxed{' || CAST(p_size AS VARCHAR) || '.0}'
              WHEN 3 THEN 'Therefore the final answer is $' || CAST(p_size AS VARCHAR) || '$.'
              ELSE 'I could not solve it.' END END AS prediction
  FROM part)"""


def fmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fmt``: assistant turns, by turn mod 3 think-wrapped / opened only / wrapped after a newline."""
    c = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    m = F.col("turn") % 3
    t = F.col("text")
    text = (
        F.when(m == 0, F.concat(F.lit("<think>"), t, F.lit("</think>"), t))
        .when(m == 1, F.concat(F.lit("<think>"), t))
        .otherwise(F.concat(F.lit("\n<think>"), t, F.lit("</think>")))
    )
    return c.select("conv_id", "turn", text.alias("completion"))


FMT_SQL = """
fmt AS (
  SELECT conv_id, turn,
         CASE turn % 3 WHEN 0 THEN '<think>' || text || '</think>' || text
                       WHEN 1 THEN '<think>' || text
                       ELSE chr(10) || '<think>' || text || '</think>' END AS completion
  FROM conversations WHERE role = 'assistant')"""
