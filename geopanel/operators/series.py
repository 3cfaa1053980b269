"""Daily, monthly and census-year series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.functions import on_weekday, single_value, slice_text
from geopanel.functions.scalar import WEEKDAYS
from geopanel.operators.compare import percent
from geopanel.operators.joins import left_join_unique
from geopanel.operators.reshape import code_columns


def inside(date: str, after: dt.date, before: dt.date) -> Column:
    """Days strictly between two dates, for a date or a timestamp column.

    Written as a half-open range over the bare column so that it reaches the scan.
    """
    first = after + dt.timedelta(days=1)
    return (F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(before))


def weekly_sample(
    df: DataFrame, date: str, after: dt.date, before: dt.date, day: str = "Sun"
) -> DataFrame:
    """Rows that fall on one weekday strictly inside the range."""
    return df.filter(inside(date, after, before) & on_weekday(date, day))


def week_range(
    after: dt.date, before: dt.date, day: str = "Sun"
) -> tuple[dt.date, dt.date] | None:
    """First and last such weekday strictly inside the range; None if there is none."""
    first = after + dt.timedelta(days=1)
    python_day = (WEEKDAYS[day] - 2) % 7  # Monday is 0 in Python
    first += dt.timedelta(days=(python_day - first.weekday()) % 7)
    if first >= before:
        return None
    return first, first + dt.timedelta(weeks=((before - first).days - 1) // 7)


def densify(
    areas: DataFrame, calendar: DataFrame, facts: DataFrame, key: str, date: str,
    span: tuple[dt.date, dt.date] | None, step: int = 7,
) -> DataFrame:
    """Every calendar date for every area, facts beside it, gaps as NULL.

    Each area row generates the dates from the first to the last of ``span`` itself,
    the calendar (one row per date, columns of overall values; a repeated date is an
    error) keeps those it has, and the facts join on both keys, so one area with most of
    the facts still spreads over partitions by date. A missing area matches facts
    without area. Facts must be unique by area and date: a repeat is an error, found by
    the aggregation whose partitioning the join then uses.
    """
    if span is None:
        raise ValueError("densify() needs at least one date")
    dates = F.sequence(*map(F.lit, span), F.expr(f"INTERVAL '{step}' DAY"))
    grid = areas.withColumn(date, F.explode(dates))
    values = [c for c in calendar.columns if c != date]
    context = calendar.groupBy(date).agg(*[single_value(c).alias(c) for c in values])
    return left_join_unique(grid.join(context, date), facts, [date, key])


def percent_of_base(
    df: DataFrame, ids: Sequence[str], code: str, value: str, part: str, base: str, out: str
) -> DataFrame:
    """100 x part / base for two codes of a long table, one aggregation."""
    grouped = df.filter(F.col(code).isin([part, base])).groupBy(*ids).agg(
        *code_columns(code, value, {part: "__part", base: "__base"})
    )
    return grouped.select(*ids, percent("__part", "__base").alias(out))


def decode_series(
    df: DataFrame, year: int, pattern: str = r"LAUCN.+03$", annual: str = "M13",
    area_width: int = 5, out: str = "value",
) -> DataFrame:
    """Monthly area series out of a labour file: area code, month label, value.

    Keeps one year and the series ids matching the pattern, and drops the annual
    average. ``area_width`` is the number of characters taken as the area code.
    """
    kept = df.filter(
        (F.col("year") == year)
        & (F.col("period") != annual)
        & F.col("series_id").rlike(pattern)
    )
    suffix = f"/01/{year % 100:02d}"
    return kept.select(
        slice_text("series_id", 6, 5 + area_width).alias("GEOID"),
        F.concat(slice_text("period", 2, 3), F.lit(suffix)).alias("month"),
        F.col("value").alias(out),
    )


def stack_vintages(
    frames: Sequence[tuple[DataFrame, int]], year: str = "year"
) -> DataFrame:
    """Row-bind one frame per vintage with its year as a column."""
    out = None
    for df, value in frames:
        part = df.withColumn(year, F.lit(value))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("stack_vintages() needs at least one frame")
    return out
