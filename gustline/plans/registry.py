"""Name -> (Spark query, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gustline.plans.sqlbase import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return register
