"""Registry of runnable queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.plans.oracle_views import using

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 9


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 9 digits: sums of floats depend on the order of addition."""
    return df.select(
        *[
            F.round(F.col(f.name), DIGITS).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(name: str, sql: str | None = None, views: Sequence[str] | str = ()):
    """Register a query with its SQL; `views` names the SQL bindings it needs."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = using(views, sql)
        return fn

    return register
