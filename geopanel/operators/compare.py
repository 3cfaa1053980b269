"""Figures derived from two sources for the same areas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.constants import CLOSE, HIGH, MONTHS_TO_APRIL, SIZE_CUTS, SLIGHT
from geopanel.functions import cases, half_even, ratio, sql
from geopanel.functions.scalar import ColumnLike, col


def interpolate(
    previous: ColumnLike, following: ColumnLike, months: int = MONTHS_TO_APRIL
) -> Column:
    """Annual figure moved ``months`` months past the previous reference date."""
    p, f = col(previous), col(following)
    return half_even(p + (f - p) / F.lit(12) * F.lit(months)).cast("bigint")


def quotient(numerator: str, denominator: str) -> Column:
    """``ratio`` of two named columns."""
    return sql("try_divide(CAST({n} AS DOUBLE), CAST({d} AS DOUBLE))",
               n=numerator, d=denominator)


def share_columns(
    prefix: str, groups: Sequence[str], total: str, suffix: str = "_TOT", out: str = "_PROP"
) -> dict[str, Column]:
    """``<prefix><group>_PROP`` = group total over the overall total."""
    return {f"{prefix}{g}{out}": quotient(f"{prefix}{g}{suffix}", total) for g in groups}


def proportions(df: DataFrame, parts: Mapping[str, str], total: str) -> DataFrame:
    """Add one share column per part: ``{new column: part column}`` over ``total``."""
    return df.withColumns({name: quotient(part, total) for name, part in parts.items()})


def household(population: str, group_quarters: str) -> Column:
    return sql("{p} - {g}", p=population, g=group_quarters)


def per_unit(population: str, group_quarters: str, units: str) -> Column:
    """Household population per housing unit."""
    return sql("try_divide(CAST({p} - {g} AS DOUBLE), CAST({u} AS DOUBLE))",
               p=population, g=group_quarters, u=units)


def size_class(
    c: ColumnLike, cuts: Sequence[tuple[float | None, str]] = tuple(SIZE_CUTS)
) -> Column:
    """Label by the first cut reached; the last label takes everything below."""
    branches = [
        (col(c) >= cut if cut is not None else col(c).isNotNull(), label)
        for cut, label in cuts
    ]
    return cases(branches)


def raw_difference(actual: str, estimate: str) -> Column:
    return sql("{a} - {e}", a=actual, e=estimate)


def share_difference(
    actual: str, estimate: str, zero_if_actual_zero: bool = False, unbounded: bool = False
) -> Column:
    """Difference over the estimate; 0 when there is no difference.

    ``zero_if_actual_zero`` also gives 0 where the actual count is 0. A difference
    against an estimate of 0 is NULL, or infinite with ``unbounded``.
    """
    settled = "{a} - {e} = 0" + (" OR {a} = 0" if zero_if_actual_zero else "")
    infinite = (
        "WHEN {e} = 0 AND {a} > 0 THEN double('Infinity') "
        "WHEN {e} = 0 AND {a} < 0 THEN double('-Infinity') "
    ) if unbounded else ""
    return sql(
        f"CASE WHEN {settled} THEN 0D {infinite}WHEN NOT ({settled}) "
        "THEN try_divide(CAST({a} - {e} AS DOUBLE), CAST({e} AS DOUBLE)) END",
        a=actual, e=estimate,
    )


def compare_sources(
    df: DataFrame, metrics: Mapping[str, str], zero_if_actual_zero: Sequence[str] = (),
    unbounded: bool = False, actual: str = "CEN_", estimate: str = "EST_",
) -> DataFrame:
    """Add ``<name>_DIFF`` and ``SHARE_<name>_DIFF`` for every ``{name: metric}``."""
    new: dict[str, Column] = {}
    for name, metric in metrics.items():
        pair = (f"{actual}{metric}", f"{estimate}{metric}")
        new[f"{name}_DIFF"] = raw_difference(*pair)
        new[f"SHARE_{name}_DIFF"] = share_difference(
            *pair, zero_if_actual_zero=name in zero_if_actual_zero, unbounded=unbounded
        )
    return df.withColumns(new)


def percent(part: ColumnLike, total: ColumnLike) -> Column:
    return ratio(part, total) * F.lit(100)


def change_label(change: ColumnLike, cuts: tuple[float, float]) -> Column:
    """Grade the size of a change, whatever its sign."""
    high, slight = cuts
    size = F.abs(col(change))
    return cases([(size >= high, HIGH), (size >= slight, SLIGHT), (size < slight, CLOSE)])


def grade_change(
    df: DataFrame, now: str, then: str, cuts: tuple[float, float],
    change: str = "change", label: str = "measure",
) -> DataFrame:
    """Add the change between two dates and its grade."""
    diff = F.col(now) - F.col(then)
    return df.withColumns({change: diff, label: change_label(diff, cuts)})
