"""Wide <-> long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geopanel.functions import split_first, sql, text


def common_type(df: DataFrame, columns: Sequence[str]) -> str:
    """BIGINT for whole numbers only, which stay exact, else DOUBLE."""
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)
    return "bigint" if whole else "double"


def to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str],
    name: str = "variable", value: str = "value",
) -> DataFrame:
    """One row per (ids, column). Values become BIGINT or DOUBLE so that all columns agree."""
    kind = common_type(df, columns)
    typed = df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in columns])
    return typed.unpivot(list(ids), list(columns), name, value)


def code_columns(
    code: str, value: str, names: Mapping[str, str] | Sequence[str]
) -> list[Column]:
    """Aggregates that spread a code/value pair into one column per listed code."""
    mapping = names if isinstance(names, Mapping) else {n: n for n in names}
    return [
        sql(
            f"CASE WHEN count_if({{c}} = {text(c)}) > 1 "
            f"THEN raise_error({text(f'code {c} is repeated within a row')}) "
            f"ELSE max({{v}}) FILTER (WHERE {{c}} = {text(c)}) END",
            c=code, v=value,
        ).alias(alias)
        for c, alias in mapping.items()
    ]


def to_wide(
    df: DataFrame, ids: Sequence[str], code: str, value: str,
    names: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """One column per listed code; a repeated (ids, code) is an error.

    Conditional aggregates need one exchange and pre-aggregate on the map side,
    where a pivot with ``first`` plans two.
    """
    return df.groupBy(*ids).agg(*code_columns(code, value, names))


def source_panel(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
    sources: Sequence[str] = ("EST", "CEN"),
) -> DataFrame:
    """Columns ``<source>_<metric>`` to rows ``(ids, variable, <source>...)``.

    A row-local generator: the same rows as unpivot, name split and pivot back,
    without their shuffle.
    """
    kind = common_type(df, [f"{s}_{m}" for s in sources for m in metrics])
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("variable"),
            *[F.col(f"{s}_{m}").cast(kind).alias(s) for s in sources],
        )
        for m in metrics
    ])
    return df.select(*ids, F.inline(rows))


def split_source(df: DataFrame, column: str = "variable", separator: str = "_") -> DataFrame:
    """Split ``<source>_<metric>`` at the first separator into two columns."""
    source, metric = split_first(column, separator)
    return df.withColumns({"source": source, column: metric})
