"""Calibrate how far an estimate usually is from the count, and grade against it.

Wide frames carry ``EST_<metric>`` and ``CEN_<metric>`` columns, one row per area.
Long frames carry ``variable, EST, CEN``, one row per area and metric.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.constants import (
    ABSOLUTE_METRICS,
    CLOSE,
    HIGH,
    MEASURE_NAMES,
    RELATIVE_METRICS,
    SLIGHT,
)
from geopanel.functions import is_member, quoted, single_value, sql, text
from geopanel.operators.joins import left_join

RANGES = ("range_1_high", "range_1_low", "range_2_high", "range_2_low")


def calibration_difference(actual: str, estimate: str, relative: bool) -> Column:
    """Relative or plain difference; missing and unbounded ones count as 0."""
    diff = "CAST({a} - {e} AS DOUBLE)"
    if relative:
        diff = f"try_divide({diff}, CAST({{e}} AS DOUBLE))"
    # NaN sorts above infinity, and a NULL comparison falls through to 0 as well.
    return sql(
        f"CASE WHEN abs({diff}) < double('Infinity') THEN {diff} ELSE 0D END",
        a=actual, e=estimate,
    )


def scoring_difference(
    actual: str, estimate: str, relative: bool, compat: bool = False
) -> Column:
    """Difference to be graded; stays missing when an input is.

    The relative form divides by the estimate, as the bands do. ``compat`` divides
    by ``actual + estimate / 2`` instead.
    """
    diff = "CAST({a} AS DOUBLE) - CAST({e} AS DOUBLE)"
    if relative:
        base = "{a} + {e} / 2D" if compat else "{e}"
        diff = (
            f"CASE WHEN {{a}} = {{e}} THEN 0D WHEN {{a}} <> {{e}} "
            f"THEN try_divide({diff}, CAST({base} AS DOUBLE)) END"
        )
    return sql(diff, a=actual, e=estimate)


def _with_ranges(df: DataFrame) -> DataFrame:
    mean, sd = F.col("mean"), F.col("sd")
    return df.withColumns({
        "range_1_high": mean + sd,
        "range_1_low": mean - sd,
        "range_2_high": mean + 2 * sd,
        "range_2_low": mean - 2 * sd,
    })


def calibrate_bands(
    df: DataFrame, relative: Sequence[str] = tuple(RELATIVE_METRICS),
    absolute: Sequence[str] = tuple(ABSOLUTE_METRICS), size: str = "SIZE_CLASS",
    estimate: str = "EST_", actual: str = "CEN_",
) -> DataFrame:
    """Mean, sample sd and bands per (metric, size class) from a wide frame.

    One aggregation grouped by size class alone, with the metrics side by side:
    the input is never multiplied into its long form, and each task ships one
    partial row per class.
    """
    metrics = [(m, True) for m in relative] + [(m, False) for m in absolute]
    diffs = df.select(size, *[
        calibration_difference(f"{actual}{m}", f"{estimate}{m}", rel).alias(m)
        for m, rel in metrics
    ])
    grouped = diffs.groupBy(size).agg(
        F.count(F.lit(1)).alias("count"),
        *[F.avg(m).alias(f"mean_{m}") for m, _ in metrics],
        *[F.stddev_samp(m).alias(f"sd_{m}") for m, _ in metrics],
    )
    cells = F.array(*[
        F.struct(
            F.lit(m).alias("variable"),
            F.col(f"mean_{m}").alias("mean"),
            F.col(f"sd_{m}").alias("sd"),
        )
        for m, _ in metrics
    ])
    long = grouped.select(size, "count", F.inline(cells))
    return _with_ranges(long.select("variable", size, "count", "mean", "sd"))


def calibrate_long(
    df: DataFrame, relative: Sequence[str] = tuple(RELATIVE_METRICS),
    exclude: Sequence[str] = (), variable: str = "variable", size: str = "SIZE_CLASS",
    estimate: str = "EST", actual: str = "CEN",
) -> DataFrame:
    """The same from a long frame; rows with a NULL variable stay in."""
    diff = F.when(
        is_member(variable, relative), calibration_difference(actual, estimate, True)
    ).otherwise(calibration_difference(actual, estimate, False))
    kept = df.filter(~is_member(variable, exclude)) if exclude else df
    grouped = (
        kept.select(variable, size, diff.alias("difference"))
        .groupBy(variable, size)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("difference").alias("mean"),
            F.stddev_samp("difference").alias("sd"),
        )
    )
    return _with_ranges(grouped)


def divergence_label(difference: str, bands: str = "") -> Column:
    """Outside two sd, outside one sd, strictly inside; else NULL.

    ``bands`` is the struct column holding the ranges, or empty when they are
    columns of their own.
    """
    prefix = f"{quoted(bands)}." if bands else ""
    high1, low1, high2, low2 = (prefix + r for r in RANGES)
    return sql(
        f"CASE WHEN {{d}} >= {high2} OR {{d}} <= {low2} THEN {text(HIGH)} "
        f"WHEN {{d}} >= {high1} OR {{d}} <= {low1} THEN {text(SLIGHT)} "
        f"WHEN {{d}} < {high1} AND {{d}} > {low1} THEN {text(CLOSE)} END",
        d=difference,
    )


def bands_by_size(
    bands: DataFrame, metrics: Sequence[str], size: str = "SIZE_CLASS",
) -> DataFrame:
    """One row per size class (and for areas without one) with a struct of ranges per metric.

    All classes the bands have are kept. A repeated (metric, class) is an error.
    """
    kept = bands.filter(F.col("variable").isin(list(metrics)))
    ranges = F.struct(*[F.col(r).cast("double").alias(r) for r in RANGES])
    return kept.groupBy(size).agg(*[
        single_value(ranges, F.col("variable") == m).alias(f"__band_{m}") for m in metrics
    ])


def score_wide(
    df: DataFrame, bands: DataFrame, relative: Sequence[str] = tuple(RELATIVE_METRICS),
    absolute: Sequence[str] = tuple(ABSOLUTE_METRICS),
    names: Mapping[str, str] = MEASURE_NAMES, size: str = "SIZE_CLASS", compat: bool = False,
    estimate: str = "EST_", actual: str = "CEN_",
) -> DataFrame:
    """Add one grade column per metric.

    The bands meet the areas as one row per size class and the grades are plain
    expressions, so the wide frame is not reshaped; nor is it shuffled while the bands
    are as small as bands are, which is for the optimizer to see.
    """
    metrics = [*relative, *absolute]
    by_size = bands_by_size(bands, metrics, size)
    differences = df.withColumns({
        f"__d_{m}": scoring_difference(
            f"{actual}{m}", f"{estimate}{m}", m in set(relative), compat
        )
        for m in metrics
    })
    joined = left_join(differences, by_size, [size])
    ordered = [m for m in names if m in metrics]
    ordered += [m for m in metrics if m not in names]
    return joined.select(*df.columns, *[
        divergence_label(f"__d_{m}", f"__band_{m}").alias(names.get(m, f"{m}_MEASURE"))
        for m in ordered
    ])


def score_long(
    df: DataFrame, bands: DataFrame, relative: Sequence[str] = tuple(RELATIVE_METRICS),
    absolute: Sequence[str] = tuple(ABSOLUTE_METRICS), size: str = "SIZE_CLASS",
    compat: bool = False, estimate: str = "EST", actual: str = "CEN",
    label: str = "divergence_measure",
) -> DataFrame:
    """Add ``difference`` and its grade to a long frame.

    A repeated (metric, class) among the bands is an error.
    """
    metrics = [*relative, *absolute]
    small = (
        bands.filter(F.col("variable").isin(list(metrics)))
        .groupBy("variable", size)
        .agg(*[single_value(F.col(r).cast("double")).alias(r) for r in RANGES])
    )
    diff = F.when(
        is_member("variable", relative), scoring_difference(actual, estimate, True, compat)
    ).otherwise(scoring_difference(actual, estimate, False))
    joined = left_join(df.withColumn("difference", diff), small, ["variable", size])
    return joined.select(
        *df.columns, "difference", divergence_label("difference").alias(label)
    )


def unmatched_bands(bands: DataFrame, df: DataFrame, size: str = "SIZE_CLASS") -> DataFrame:
    """Size classes that have bands but no graded area, one row each."""
    graded = df.select(F.col(size).alias("__size")).distinct()
    return bands.select(size).distinct().join(
        graded, F.col(size).eqNullSafe(F.col("__size")), "left_anti"
    )
