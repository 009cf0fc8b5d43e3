"""Registered queries for schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollwise.operators import schedule as S
from rollwise.plans.fixtures import ROLL_SQL, roll
from rollwise.plans.registry import register
from rollwise.sources.tables import read_table


def _sched_sql(table: str, key: str, b: int, r: int, m: int, shuffle: bool) -> str:
    order = f"md5('42:' || {key}), {key}" if shuffle else key
    return f"""WITH p AS (SELECT {key} AS key, row_number() OVER (ORDER BY {order}) - 1 AS pos, count(*) OVER () AS n FROM {table}),
k AS (SELECT key, pos // {b} AS chunk, pos % {b} AS idx FROM p WHERE pos < (n // {b}) * {b}),
s AS (SELECT k.*, t1.r AS repeat, t2.m AS mini FROM k, range({r}) t1(r), range({m}) t2(m))
SELECT CAST(chunk * {b * r * m} + repeat * {b * m} + idx * {m} + mini AS BIGINT) AS sched_pos,
       CAST(chunk AS BIGINT) AS chunk, CAST(repeat AS BIGINT) AS repeat, CAST(idx AS BIGINT) AS idx,
       CAST(mini AS BIGINT) AS mini, key AS {key}
FROM s"""


@register("t3_repeat_schedule", _sched_sql("customer", "c_custkey", 8, 2, 3, True))
def t3_repeat_schedule(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey")
    return S.repeat_schedule(cust, "c_custkey", batch_size=8, repeat_count=2, mini_repeat_count=3, shuffle=True)


@register("t3_repeat_schedule_ordered", _sched_sql("customer", "c_custkey", 7, 1, 2, False))
def t3_repeat_schedule_ordered(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey")
    return S.repeat_schedule(cust, "c_custkey", batch_size=7, repeat_count=1, mini_repeat_count=2, shuffle=False)


@register("t4_eval_schedule", _sched_sql("benchmark", "item_id", 1, 1, 4, True))
def t4_eval_schedule(spark, sf):
    b = read_table(spark, sf, "benchmark").select("item_id")
    return S.eval_schedule(b, "item_id", 4)


@register(
    "t5_equal_slices",
    f"""WITH sched AS ({_sched_sql("customer", "c_custkey", 8, 2, 3, True)}),
x AS (SELECT *, sched_pos - chunk * 48 AS pos_in_batch, count(*) OVER (PARTITION BY chunk) AS n FROM sched)
SELECT chunk, sched_pos, c_custkey, CAST(floor(pos_in_batch / (n // 5)) AS BIGINT) AS slice
FROM x WHERE floor(pos_in_batch / (n // 5)) < 5""",
)
def t5_equal_slices(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey")
    sched = S.repeat_schedule(cust, "c_custkey", batch_size=8, repeat_count=2, mini_repeat_count=3)
    sched = sched.withColumn("pos_in_batch", F.col("sched_pos") - F.col("chunk") * 48)
    return S.equal_slices(sched, "chunk", "pos_in_batch", 5).select("chunk", "sched_pos", "c_custkey", "slice")


@register("t7_block_heads", f"WITH {ROLL_SQL}\nSELECT prompt_key, step, rollout_id FROM roll WHERE slot = 0")
def t7_block_heads(spark, sf):
    return S.block_heads(roll(spark, sf)).select("prompt_key", "step", "rollout_id")


@register(
    "t8_last_n_log",
    f"WITH {ROLL_SQL}\nSELECT rollout_id, prompt_key, completion FROM roll ORDER BY seq DESC LIMIT 50",
)
def t8_last_n_log(spark, sf):
    return S.last_n(roll(spark, sf), 50).select("rollout_id", "prompt_key", "completion")
