"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import stage

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood (itself included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "components-least")
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them; edges point from larger to smaller."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the least node of its component.

    Rows with a null end or equal ends add no link. Every round is written to the shared
    checkpoint folder, so lineage stays short; joins read written tables on both sides, which
    lets adaptive execution split the rows of a hot node. Raises if MAX_ROUNDS (far above the
    logarithmic number needed) do not settle it.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stage(pairs, "components-edges")
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        now = stage(_small_star(stage(_large_star(now), "components-large")), "components-small")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
