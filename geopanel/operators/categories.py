"""Coded categories: decode, collapse, reallocate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.constants import CATEGORY_ITEMS, LAST_ITEM
from geopanel.functions import (
    half_even,
    if_else,
    number_key,
    slice_text,
    sql,
    sum_columns,
    text,
)
from geopanel.functions.scalar import ColumnLike


def code_list(prefix: str, suffix: str = "", last: int = LAST_ITEM, width: int = 3) -> list[str]:
    """Codes ``<prefix><number><suffix>`` for 1 to ``last``, zero-padded."""
    return [f"{prefix}{n:0{width}d}{suffix}" for n in range(1, last + 1)]


def code_rows(spark, prefix: str, suffix: str = "", last: int = LAST_ITEM, width: int = 3):
    """The same list as a frame ``(item, code)``, for joins."""
    numbers = spark.range(1, last + 1).select(F.col("id").cast("int").alias("item"))
    return numbers.withColumn(
        "code", F.concat(F.lit(prefix), number_key("item", width), F.lit(suffix))
    )


def decode_code(code: ColumnLike) -> dict[str, Column]:
    """Table digit, item number and age group of a code such as ``P2_001N``."""
    digit = slice_text(code, -6, -6)
    return {
        "table": digit,
        "item": slice_text(code, -3, -2),
        "age": if_else(digit == "2", F.lit("total"), F.lit("over17")),
    }


def category_columns(
    code: str, value: str, groups: Mapping[str, Sequence[str]]
) -> list[Column]:
    """Aggregates that add up the listed codes of each group.

    A group with a missing or NULL code is NULL; a repeated code is an error, also beside
    a missing one: a group has as many rows as it has different codes, which are
    counted as bits.
    """
    out = []
    for name, codes in groups.items():
        codes = list(dict.fromkeys(codes))
        member = f"{{c}} IN ({', '.join(map(text, codes))})"
        found = " + ".join(
            f"bit_count(coalesce(bit_or({_bits(codes[at:at + 63])}), 0L))"
            for at in range(0, len(codes), 63)
        )
        out.append(sql(
            f"CASE WHEN count_if({member}) > {found} "
            f"THEN raise_error({text(f'a code of group {name} is repeated')}) "
            f"WHEN count({{v}}) FILTER (WHERE {member}) = {len(codes)} "
            f"THEN sum({{v}}) FILTER (WHERE {member}) END",
            c=code, v=value,
        ).alias(name))
    return out


def _bits(codes: Sequence[str]) -> str:
    """One bit per code, as SQL."""
    return "CASE {c} " + " ".join(
        f"WHEN {text(c)} THEN {1 << n}L" for n, c in enumerate(codes)
    ) + " END"


def collapse_categories(
    df: DataFrame, ids: Sequence[str], code: str, value: str,
    groups: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Long codes to one column per group, in a single aggregation.

    No column per code is ever built; map-side partial sums are one row per area.
    """
    return df.groupBy(*ids).agg(*category_columns(code, value, groups))


def race_groups(prefix: str = "P2_", suffix: str = "N") -> dict[str, list[str]]:
    """Codes of each category of the race-by-origin table."""
    return {
        name: [f"{prefix}{item:03d}{suffix}" for item in items]
        for name, items in CATEGORY_ITEMS.items()
    }


def reallocate(
    df: DataFrame, source: str, factors: Mapping[str, float], bases: Mapping[str, str],
    residual_to: str, out: Mapping[str, str],
) -> DataFrame:
    """Spread one category over others by fixed factors, keeping the total.

    Each part is rounded; what rounding gains or loses goes to ``residual_to``.
    ``bases`` and ``out`` name, per factor, the column added to and the new column.
    """
    parts = {g: half_even(F.col(source) * F.lit(f)).cast("bigint") for g, f in factors.items()}
    excess = sum_columns(list(parts.values())) - F.col(source)
    new = {}
    for group, part in parts.items():
        share = part - excess if group == residual_to else part
        new[out[group]] = (F.col(bases[group]) + share).cast("bigint")
    return df.withColumns(new)
