"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Each query reads the given parquet tables (through ``sitewatch.fixtures``)
and runs one or more operators over the whole tables. Timestamps leave as
TIMESTAMP_NTZ so that they compare zone-free with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitewatch.session import configure_session

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query (and its oracle SQL, if SQL can express it)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure_session(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLE[name] = oracle
        return run
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load():
    # Importing the modules runs their @register decorators.
    from sitewatch.plans import (q_windows, q_match, q_topn, q_latest,  # noqa: F401
                                 q_io, q_calendar)
