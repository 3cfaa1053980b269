"""The main table: counts beside estimates, differences and grades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.constants import (
    AREA_NOTES,
    AREA_RENAMES,
    COUNT_ALIASES,
    COUNTY_MAIN_COLUMNS,
    DIFF_METRICS,
    GROUPS,
    MEASURE_NAMES,
    MERGED_AREAS,
    ROLLED_UP_AREAS,
    SIZE_CUTS,
    SPLIT_AREAS,
    VACANCY_CODES_2010,
    VACANCY_CUTS,
    ZERO_IF_ACTUAL_ZERO,
)
from geopanel.operators.bands import score_wide, unmatched_bands
from geopanel.operators.columns import bind_rows
from geopanel.operators.compare import (
    compare_sources,
    grade_change,
    household,
    per_unit,
    percent,
    share_columns,
    size_class,
)
from geopanel.operators.crosswalk import Crosswalk, Members, roll_up
from geopanel.operators.enrich import notes, repair_names
from geopanel.operators.joins import full_join
from geopanel.plans.calibration import vacancy_2010

_SOURCES = ("CEN_", "EST_")


def counts_beside_estimates(
    counts: DataFrame, estimates: DataFrame, rolled_up: Members = ROLLED_UP_AREAS,
    unbounded: bool = False,
) -> DataFrame:
    """Counts, their estimates, raw and share differences, vacancy, names, notes."""
    cen = counts.select(*[F.col(c).alias(a) for c, a in COUNT_ALIASES.items()])
    both = roll_up(cen, "GEOID", rolled_up).join(estimates, "GEOID", "left")
    derived = both.withColumns({
        "CTYNAME": repair_names("CTYNAME", AREA_RENAMES),
        "PCT_VACANT_HU_2020": percent("CEN_HU_VACANT_TOT", "CEN_HU_TOT"),
        "NOTES": notes("GEOID", AREA_NOTES),
        **{f"{s}HH_TOT": household(f"{s}POP_TOT", f"{s}GQ_TOT") for s in _SOURCES},
        **{
            f"{s}PPH_TOT": per_unit(f"{s}POP_TOT", f"{s}GQ_TOT", f"{s}HU_TOT")
            for s in _SOURCES
        },
    })
    return compare_sources(derived, DIFF_METRICS, ZERO_IF_ACTUAL_ZERO, unbounded)


def county_main(
    counts: DataFrame, estimates: DataFrame, bands: DataFrame, housing_2010_long: DataFrame,
    compat: bool = False, rolled_up: Members = ROLLED_UP_AREAS,
    merged: Crosswalk = MERGED_AREAS, split: Members = SPLIT_AREAS,
    size_cuts=tuple(SIZE_CUTS),
) -> DataFrame:
    """All areas with their grades, 70 columns in published order.

    Grades are added to the counts row by row; only the 2010 vacancy is joined, as a
    full join since it may hold areas without a 2020 count. ``compat`` scores with
    the wider denominator, keeps unbounded shares, does not hand 2010 vacancy on to
    split areas and keeps bands no area matched.
    """
    base = counts_beside_estimates(counts, estimates, rolled_up, unbounded=compat)
    shares = {}
    for s in _SOURCES:
        shares |= share_columns(s, GROUPS, f"{s}POP_TOT")
        shares[f"{s}PPH_RAT"] = F.col(f"{s}PPH_TOT")
    sized = base.withColumns(
        {**shares, "SIZE_CLASS": size_class("CEN_POP_TOT", size_cuts)}
    )
    graded = score_wide(sized, bands, compat=compat).drop(*shares)
    vacancy = vacancy_2010(
        housing_2010_long, merged, None if compat else split,
        VACANCY_CODES_2010, "PCT_VACANT_HU_2010",
    )
    table = grade_change(
        # The wide side is already partitioned by area from the join above.
        full_join(graded, vacancy, ["GEOID"], nullable=False, check=False),
        "PCT_VACANT_HU_2020", "PCT_VACANT_HU_2010",
        VACANCY_CUTS, "PCT_VACANT_CHANGE", "VACANCY_MEASURE",
    ).select(*COUNTY_MAIN_COLUMNS)
    if compat:
        known = bands.filter(F.col("variable").isin(list(MEASURE_NAMES)))
        table = bind_rows(table, unmatched_bands(known, sized), fill=True)
    return table
