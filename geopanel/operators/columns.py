"""Column-order and row-bind helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def containing(df: DataFrame, text: str) -> list[str]:
    """Columns whose name contains the text, ignoring case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def relocate(df: DataFrame, *front: str | Sequence[str]) -> DataFrame:
    """Move columns to the front in the order named; the others keep their order."""
    order: list[str] = []
    for item in front:
        for name in [item] if isinstance(item, str) else item:
            if name not in order:
                order.append(name)
    return df.select(*order, *[c for c in df.columns if c not in order])


def bind_rows(first: DataFrame, *others: DataFrame, fill: bool = False) -> DataFrame:
    """Stack frames by column name, keeping duplicates.

    Without ``fill`` the column sets must agree; with it a missing column is NULL.
    """
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=fill)
    return out


def with_prefix(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})
