"""Benchmark normalisation to ``(dataset, problem, answer)`` and union."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.functions.text import trim_ws

# Which aliases take the marker case and the list case; all others take the default case.
MARKER_ALIASES = ("gsm8k",)
LIST_ALIASES = ("olympiadbench",)

# First "####", any whitespace (newlines included), then the rest of that line.
# ``[^\n]`` stands for Python's ``.``: Java's ``.`` would also stop at \r and U+2028/9.
MARKER_PATTERN = r"####\s*([^\n]+)"


def marker_answer(raw: Column) -> Column:
    """Text after the first ``####`` marker, stripped; the whole text stripped when absent."""
    return F.when(raw.rlike(MARKER_PATTERN), trim_ws(F.regexp_extract(raw, MARKER_PATTERN, 1))).otherwise(trim_ws(raw))


def normalize(df: DataFrame, alias: str) -> DataFrame:
    """One source table to ``(dataset, problem, answer)``; the case follows the alias.

    In the default case the problem column is chosen by presence (``problem``, else
    ``question``, else empty), decided from the schema when the plan is built.
    """
    cols = set(df.columns)
    if alias in MARKER_ALIASES:
        problem, answer = F.col("question"), marker_answer(F.col("answer"))
    elif alias in LIST_ALIASES:
        problem = F.array_join(F.col("solution"), " ")
        first = F.try_element_at(F.col("final_answer"), F.lit(1))
        answer = F.coalesce(trim_ws(first), F.lit(""))
    else:
        problem = F.col("problem") if "problem" in cols else F.col("question") if "question" in cols else F.lit("")
        answer = trim_ws(F.col("answer")) if "answer" in cols else F.lit("")
    return df.select(F.lit(alias).alias("dataset"), problem.alias("problem"), answer.alias("answer"))


def union_benchmarks(parts: Iterable[DataFrame]) -> DataFrame:
    """Union by column name (no dedupe, like a concatenation)."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def aliases(combined: DataFrame) -> DataFrame:
    """The distinct dataset aliases of a combined table."""
    return combined.select("dataset").distinct()
