"""Registry of checked queries: one Spark query and, where SQL can say it, one DuckDB oracle
per operator. Keys are ``<operator id>_<name>``.

Every query reads the driver's tables at ``sf_dir`` (directly or through the fixtures), so
its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkrisk.session import prepare


@dataclass(frozen=True)
class Query:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle SQL."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if key in _QUERIES:
            raise ValueError(f"duplicate query {key}")
        _QUERIES[key] = Query(key, run, sql)
        return fn

    return wrap


def _load() -> None:
    # Importing the modules registers their queries.
    from sparkrisk.plans import (  # noqa: F401
        q_history,
        q_model,
        q_ops,
        q_profile,
        q_sources,
        q_text,
    )


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in all_queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in all_queries().items() if q.sql is not None}
