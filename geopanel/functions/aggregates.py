"""Aggregates in which one missing input makes the result missing.

Each is an ordinary declarative aggregate: Spark pre-aggregates on the map side, so
a group holding a large part of all rows ships one partial row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geopanel.functions.scalar import ColumnLike, col


def _strict(aggregate: Callable[[Column], Column], c: ColumnLike) -> Column:
    complete = F.count(F.lit(1)) == F.count(col(c))
    return F.when(complete, aggregate(col(c)))


def strict_sum(c: ColumnLike) -> Column:
    return _strict(F.sum, c)


def strict_mean(c: ColumnLike) -> Column:
    return _strict(F.avg, c)


def strict_sd(c: ColumnLike) -> Column:
    """Sample standard deviation; NULL for a single row."""
    return _strict(F.stddev_samp, c)


def single_value(c: ColumnLike, when: Column | None = None) -> Column:
    """The one value of a group (or of its rows matching ``when``).

    More than one row is an error rather than a silent pick, so a reshape that
    would lose rows fails. No row gives NULL.
    """
    rows = F.count(F.lit(1)) if when is None else F.count(F.when(when, 1))
    value = F.max(col(c) if when is None else F.when(when, col(c)))
    return F.when(
        rows > 1, F.raise_error(F.lit("more than one row for a cell that must be unique"))
    ).otherwise(value)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]
