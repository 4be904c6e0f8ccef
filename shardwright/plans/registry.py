"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the fixture tables (or
tables Spark derives from them). The oracle, when one exists, is ANSI SQL
over the same tables registered as views; column names match exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..session import spread
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def load_all():
    """Import every query module so the registry is complete."""
    from . import chat_queries, choice_queries, run_queries, text_queries  # noqa: F401
    from . import vocab_queries, window_queries, stream_queries  # noqa: F401
    return QUERIES, ORACLES
