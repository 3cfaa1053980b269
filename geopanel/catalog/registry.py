"""Registry of queries, and what all of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from geopanel.functions import quoted

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def presentable(df: DataFrame) -> DataFrame:
    """Doubles rounded to a fixed number of digits, dates as ISO text."""
    shown = {T.DoubleType: f"round({{}}, {DIGITS}) AS {{}}", T.DateType: "string({}) AS {}"}
    return df.selectExpr(*[
        shown.get(type(field.dataType), "{}").format(*[quoted(field.name)] * 2)
        for field in df.schema
    ])


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""

    def register(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: presentable(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
