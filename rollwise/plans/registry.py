"""Registry of named queries: a Spark builder and, where SQL can say it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from rollwise.plans import (  # noqa: F401
        q_eval,
        q_grading,
        q_io,
        q_loss,
        q_metrics,
        q_prep,
        q_replay,
        q_schedule,
        q_streaming,
    )
