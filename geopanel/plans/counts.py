"""County counts with "some other race" reallocated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.constants import EXCLUDED_STATE, HOUSING_CODES, REALLOCATION_FACTORS
from geopanel.operators.categories import category_columns, race_groups, reallocate
from geopanel.operators.enrich import area_names, outside_state
from geopanel.operators.reshape import code_columns

_BASES = {
    "white": "white_alone", "black": "black_alone", "aian": "aian_alone",
    "asian": "asian_alone", "nhpi": "nhpi_alone", "multi": "multi_race",
}
_TOTALS = {
    "white": "white_all_all", "black": "black_all_all", "aian": "aian_all_all",
    "asian": "asian_all_all", "nhpi": "nhpi_all_all", "multi": "twoplus_all_all",
}


def county_pl(
    population: DataFrame, housing: DataFrame, codes: DataFrame,
    excluded_state: str = EXCLUDED_STATE,
) -> DataFrame:
    """Population by race and origin, housing units and group quarters per area.

    ``population`` and ``housing`` are long tables (GEOID, NAME, variable, value).
    Stacking them first lets a single aggregation collapse the race codes and spread
    the housing codes: one exchange, and an area found in only one of the two keeps
    its row, as in a full join on (GEOID, NAME).
    """
    groups = race_groups()
    wanted = sorted({c for items in groups.values() for c in items})
    columns = ["GEOID", "NAME", "variable", "value"]
    people = population.filter(F.col("variable").isin(wanted)).select(*columns)
    units = housing.filter(F.col("variable").isin(list(HOUSING_CODES))).select(*columns)
    wide = (
        people.unionByName(units)
        .filter(outside_state("GEOID", excluded_state))
        .groupBy("GEOID", "NAME")
        .agg(
            *category_columns("variable", "value", groups),
            *code_columns("variable", "value", HOUSING_CODES),
        )
    )
    spread = reallocate(wide, "sor_alone", REALLOCATION_FACTORS, _BASES, "white", _TOTALS)
    named = area_names(spread, "GEOID", codes)
    return named.select(
        F.col("GEOID").alias("fips"), "stabbrev", "countynm",
        "total_all_all", "all_hisp_all", *_TOTALS.values(), *HOUSING_CODES.values(),
    )
