"""Registry of named queries: Spark builder plus (optionally) its DuckDB oracle SQL.

Each query reads whole driver tables (or shapes derived from them); none runs on
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from threadmill.plans import q_corpus, q_dedup, q_eval, q_io, q_math, q_messages, q_more, q_results, q_sources, q_streams, q_splits, q_stats, q_text, q_tokens, q_traces  # noqa: F401
