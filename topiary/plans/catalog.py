"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, plus the
DuckDB oracle SQL where the operator is SQL-expressible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module (registration happens at import)."""
    from topiary.plans import (  # noqa: F401
        q_alignment,
        q_coherence,
        q_extensions,
        q_model,
        q_online_lda,
        q_store,
        q_text,
        q_tokens,
        q_views,
        q_vocab,
    )
