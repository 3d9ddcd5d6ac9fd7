"""Query catalogue: name -> (Spark job, oracle SQL).

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching SQL (if any) is an independent statement of the same result that DuckDB
runs over the same parquet tables. Column names and types agree on both sides;
floating results are rounded to 6 digits in both.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from . import q_cleaning, q_narrative, q_metrics, q_models, q_clusters  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
