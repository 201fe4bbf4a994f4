"""Collects the checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from registry.views import Views, cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(*views: str, sql: str | None = None):
    """Register a function of `Views`; `sql` is its check, over the named views."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = f"{cte(*views)} {sql}" if views else sql
        return fn

    return register
