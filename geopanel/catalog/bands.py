"""Calibration and grading."""

from __future__ import annotations

from geopanel.catalog.inputs import SIZED_SQL, SIZES, area_panel, graded_panel, long_sql
from geopanel.catalog.registry import query
from geopanel.constants import (
    ABSOLUTE_METRICS,
    CLOSE,
    GROUPS,
    HIGH,
    MEASURE_NAMES,
    RELATIVE_METRICS,
    SLIGHT,
)
from geopanel.operators import bands as B
from geopanel.operators.compare import size_class
from geopanel.operators.enrich import compare_long, join_long
from geopanel.operators.reshape import (
    source_panel,
    split_source,
    to_long,
    to_wide,
)

METRICS = [*RELATIVE_METRICS, *ABSOLUTE_METRICS]
_RELATIVE = "variable IN ('POP_TOT', 'HU_TOT', 'GQ_TOT')"

_DIFFS = f"""diffs AS (SELECT *, CASE WHEN {_RELATIVE}
    THEN coalesce((CEN - EST) / nullif(EST, 0), 0) ELSE coalesce(CEN - EST, 0) END AS d
  FROM long)"""
_BANDS = """bands AS (SELECT variable, SIZE_CLASS, count(*) AS count, avg(d) AS mean,
    stddev_samp(d) AS sd, avg(d) + stddev_samp(d) AS range_1_high,
    avg(d) - stddev_samp(d) AS range_1_low, avg(d) + 2 * stddev_samp(d) AS range_2_high,
    avg(d) - 2 * stddev_samp(d) AS range_2_low FROM diffs GROUP BY variable, SIZE_CLASS)"""
_BANDS_OUT = """SELECT variable, SIZE_CLASS, count, round(mean, 6) AS mean, round(sd, 6) AS sd,
  round(range_1_high, 6) AS range_1_high, round(range_1_low, 6) AS range_1_low,
  round(range_2_high, 6) AS range_2_high, round(range_2_low, 6) AS range_2_low FROM bands"""
_CALIBRATED = f"WITH {SIZED_SQL}, {long_sql(METRICS)}, {_DIFFS}, {_BANDS} "


def _scored(denominator: str) -> str:
    return f"""scored AS (SELECT area, variable, SIZE_CLASS, difference,
    CASE WHEN difference >= range_2_high OR difference <= range_2_low THEN '{HIGH}'
         WHEN difference >= range_1_high OR difference <= range_1_low THEN '{SLIGHT}'
         WHEN difference < range_1_high AND difference > range_1_low THEN '{CLOSE}' END AS label
  FROM (SELECT area, variable, SIZE_CLASS, CASE WHEN {_RELATIVE}
          THEN CASE WHEN CEN - EST = 0 THEN 0 ELSE (CEN - EST) / nullif({denominator}, 0) END
          ELSE CEN - EST END AS difference FROM long) d
  LEFT JOIN (SELECT variable AS v, SIZE_CLASS AS s, * EXCLUDE (variable, SIZE_CLASS)
    FROM bands) b ON b.v = d.variable AND b.s IS NOT DISTINCT FROM d.SIZE_CLASS)"""


def _wide_sql(denominator: str) -> str:
    columns = ", ".join(
        f"max(label) FILTER (WHERE variable = '{m}') AS {name}"
        for m, name in MEASURE_NAMES.items()
    )
    return (
        f"{_CALIBRATED}, {_scored(denominator)} "
        f"SELECT area, SIZE_CLASS, {columns} FROM scored GROUP BY area, SIZE_CLASS"
    )


@query(_CALIBRATED + _BANDS_OUT)
def calibrate_bands(spark, sf_dir):
    return B.calibrate_bands(graded_panel(spark, sf_dir))


_TOTALS = [f"{g}_TOT" for g in GROUPS]
_ALL = ["POP_TOT", *_TOTALS, "HU_TOT", "GQ_TOT", *[f"{g}_PROP" for g in GROUPS], "PPH_RAT"]


@query(
    f"WITH {SIZED_SQL}, {long_sql(_ALL, 'every')}, long AS (SELECT * FROM every "
    f"WHERE variable NOT IN ({', '.join(repr(t) for t in _TOTALS)})), {_DIFFS}, {_BANDS} "
    + _BANDS_OUT
)
def calibrate_bands_long(spark, sf_dir):
    """From the long panel, with the group totals filtered out again."""
    panel = source_panel(graded_panel(spark, sf_dir), ["area", "SIZE_CLASS"], _ALL)
    return B.calibrate_long(panel, exclude=_TOTALS)


@query(
    f"{_CALIBRATED}, {_scored('EST')} SELECT area, variable, SIZE_CLASS, "
    "round(difference, 6) AS difference, label AS divergence_measure FROM scored"
)
def score_divergence(spark, sf_dir):
    wide = graded_panel(spark, sf_dir)
    panel = source_panel(wide, ["area", "SIZE_CLASS"], METRICS)
    bands = B.calibrate_bands(wide)
    return B.score_long(panel, bands).select(
        "area", "variable", "SIZE_CLASS", "difference", "divergence_measure"
    )


@query(_wide_sql("EST"))
def score_wide(spark, sf_dir):
    wide = graded_panel(spark, sf_dir)
    graded = B.score_wide(wide, B.calibrate_bands(wide))
    return graded.select("area", "SIZE_CLASS", *MEASURE_NAMES.values())


@query(_wide_sql("(CEN + EST / 2)"))
def score_wide_compat(spark, sf_dir):
    wide = graded_panel(spark, sf_dir)
    graded = B.score_wide(wide, B.calibrate_bands(wide), compat=True)
    return graded.select("area", "SIZE_CLASS", *MEASURE_NAMES.values())


_FOUR = [(500, "Huge"), *SIZES]
_FOUR_SQL = _wide_sql("EST").replace(
    "CASE WHEN CEN_POP_TOT >= 450", "CASE WHEN CEN_POP_TOT >= 500 THEN 'Huge' WHEN CEN_POP_TOT >= 450"
)


@query(_FOUR_SQL)
def score_more_classes(spark, sf_dir):
    """A size class the published table does not have is calibrated and graded like any."""
    wide = graded_panel(spark, sf_dir).withColumn("SIZE_CLASS", size_class("CEN_POP_TOT", _FOUR))
    graded = B.score_wide(wide, B.calibrate_bands(wide))
    return graded.select("area", "SIZE_CLASS", *MEASURE_NAMES.values())


_EITHER = ["POP_TOT", "HU_TOT", "GQ_TOT"]


@query(f"WITH {SIZED_SQL}, {long_sql(_EITHER, kind='BIGINT')} SELECT * FROM long")
def split_and_pivot(spark, sf_dir):
    """Unpivot every source column, split its name, pivot the sources back."""
    wide = graded_panel(spark, sf_dir)
    long = to_long(
        wide, ["area", "SIZE_CLASS"], [f"{s}_{m}" for s in ("EST", "CEN") for m in _EITHER]
    )
    return to_wide(
        split_source(long), ["area", "SIZE_CLASS", "variable"], "source", "value",
        ["EST", "CEN"],
    )


# Counts of parts with a large late quantity; estimates of those with a large early one and
# of all parts without a count. Every part is on some side, and either side has parts that
# the other lacks.
_PARTIAL = f"""WITH {SIZED_SQL}, sides AS (
    SELECT coalesce(e.area, c.area) AS area, c.SIZE_CLASS,
      e.EST_POP_TOT, e.EST_HU_TOT, e.EST_GQ_TOT, c.CEN_POP_TOT, c.CEN_HU_TOT, c.CEN_GQ_TOT
    FROM (SELECT * FROM sized WHERE EST_POP_TOT >= 300 OR coalesce(CEN_POP_TOT, 0) < 300) e
    FULL JOIN (SELECT * FROM sized WHERE CEN_POP_TOT >= 300) c ON e.area = c.area),
  {long_sql(_EITHER, source='sides', kind='BIGINT')} """


def _sides(spark, sf_dir):
    panel = area_panel(spark, sf_dir)
    names = {s: {f"{s}_{m}": m for m in _EITHER} for s in ("EST", "CEN")}
    est = panel.filter("EST_POP_TOT >= 300 OR coalesce(CEN_POP_TOT, 0) < 300").select(
        "area", *names["EST"]).withColumnsRenamed(names["EST"])
    cen = panel.filter("CEN_POP_TOT >= 300").select("area", *names["CEN"]) \
        .withColumnsRenamed(names["CEN"])
    return est, cen.withColumn("SIZE_CLASS", size_class("POP_TOT", SIZES))


@query(_PARTIAL + "SELECT * FROM long")
def compare_long_panel(spark, sf_dir):
    est, cen = _sides(spark, sf_dir)
    return compare_long(est, cen, ["area"], _EITHER, keep=["SIZE_CLASS"])


@query(_PARTIAL + "SELECT * FROM long")
def join_long_tables(spark, sf_dir):
    """Each source unpivoted on its own, then a full join on (area, variable)."""
    est, cen = _sides(spark, sf_dir)
    return join_long(est, cen, ["area"], _EITHER, keep=["SIZE_CLASS"])
