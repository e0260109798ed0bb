"""Named queries and, where SQL can say the same, their SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.plans.oracle import with_views
from loanloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame, digits: int) -> DataFrame:
    """Round double columns so that different summation orders compare equal."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def query(
    name: str, sql: str | None = None, views: dict[str, str] | None = None, digits: int | None = 4
) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(tune(spark), sf_dir)
            return out if digits is None else tidy(out, digits)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, views)
        return fn

    return register


def load_all() -> None:
    from loanloom.plans import (  # noqa: F401
        aggregate_queries, evaluation_queries, feature_queries, join_queries,
        model_queries, policy_queries, source_queries, statistic_queries,
    )
