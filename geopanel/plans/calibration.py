"""Bands of the 2010 divergence between estimates and counts, and 2010 vacancy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.constants import (
    CUTPOINT_COLUMNS,
    EXCLUDED_STATE,
    GQ_CODES_2010,
    GROUPS,
    HOUSING_CODES_2010,
    MERGED_AREAS,
    SIZE_CUTS,
    SPLIT_AREAS,
)
from geopanel.functions import number_key
from geopanel.operators.bands import calibrate_bands
from geopanel.operators.columns import with_prefix
from geopanel.operators.compare import (
    interpolate,
    per_unit,
    percent,
    proportions,
    size_class,
)
from geopanel.operators.crosswalk import Crosswalk, Members, merge_keys, replicate_keys
from geopanel.operators.enrich import outside_state
from geopanel.operators.joins import combine_sources
from geopanel.operators.reshape import to_wide
from geopanel.plans.estimates import group_totals

_IDS = ["GEOID", "STNAME", "CTYNAME"]
_SHARES = {f"{g}_PROP": f"{g}_TOT" for g in GROUPS}


def _derived(df: DataFrame) -> DataFrame:
    """Shares of the population and household population per unit."""
    return proportions(df, _SHARES, "POP_TOT").withColumn(
        "PPH_RAT", per_unit("POP_TOT", "GQ_TOT", "HU_TOT")
    )


def _characteristics(df: DataFrame, year: int, key) -> DataFrame:
    return df.filter((F.col("YEAR") == year) & (F.col("AGEGRP") == 0)).select(
        key.alias("GEOID"), "STNAME", "CTYNAME", F.col("TOT_POP").alias("POP_TOT"),
        *group_totals(),
    )


def estimates_2010(
    characteristics: DataFrame, housing: DataFrame, components: DataFrame
) -> DataFrame:
    """Estimated figures per area; areas missing from one source keep their row."""
    people = _characteristics(
        characteristics, 13, F.concat(number_key("STATE", 2), number_key("COUNTY", 3))
    )
    units = housing.filter(F.col("sumlev") == "050").select(
        F.concat("state", "county").alias("GEOID"), F.col("huest_042010").alias("HU_TOT")
    )
    quarters = components.filter(F.col("SUMLEV") == "050").select(
        F.concat("STATE", "COUNTY").alias("GEOID"),
        interpolate("GQESTIMATES2009", "GQESTIMATES2010").alias("GQ_TOT"),
    )
    return _derived(combine_sources([people, units, quarters], ["GEOID"]))


def housing_2010(
    long: DataFrame, codes=None, excluded_state: str | None = EXCLUDED_STATE
) -> DataFrame:
    """Housing units, total and vacant, per area outside the excluded state."""
    return to_wide(
        long.filter(outside_state("GEOID", excluded_state)), ["GEOID"], "variable", "value",
        codes or HOUSING_CODES_2010,
    )


def counts_2010(
    characteristics: DataFrame, quarters: DataFrame, housing: DataFrame,
    excluded_state: str | None = EXCLUDED_STATE,
) -> DataFrame:
    """Counted figures per area."""
    people = _characteristics(characteristics, 1, F.concat("STATE", "COUNTY"))
    gq_code = next(iter(GQ_CODES_2010))
    gq = quarters.filter(
        (F.col("variable") == gq_code) & outside_state("GEOID", excluded_state)
    ).select("GEOID", F.col("value").alias("GQ_TOT"))
    units = housing_2010(housing, excluded_state=excluded_state).drop("HU_VAC")
    return _derived(combine_sources([people, gq, units], ["GEOID"]))


def cutpoints(
    characteristics_est: DataFrame, housing_est: DataFrame, components: DataFrame,
    characteristics_cen: DataFrame, quarters_cen: DataFrame, housing_cen: DataFrame,
    size_cuts=tuple(SIZE_CUTS), excluded_state: str | None = EXCLUDED_STATE,
) -> DataFrame:
    """Mean, sd and bands per metric and size class.

    The counted quarters and housing of ``excluded_state`` are left out (None: of no state).

    The two sources meet wide on (GEOID, names) and are calibrated side by side; the
    long panel of metrics is never materialised. Only numbers are aggregated there, so
    it is a hash aggregation; the size class is derived afterwards.
    """
    est = estimates_2010(characteristics_est, housing_est, components)
    cen = counts_2010(characteristics_cen, quarters_cen, housing_cen, excluded_state)
    panel = combine_sources(
        [with_prefix(est, "EST_", _IDS), with_prefix(cen, "CEN_", _IDS)], _IDS
    )
    sized = panel.withColumn("SIZE_CLASS", size_class("CEN_POP_TOT", size_cuts))
    return calibrate_bands(sized).select(*CUTPOINT_COLUMNS)


def vacancy_2010(
    housing: DataFrame, merged: Crosswalk = MERGED_AREAS, split: Members | None = SPLIT_AREAS,
    codes=None, out: str = "cen2010_pct_vacant_hu",
) -> DataFrame:
    """Vacancy rate per area of the newer geography.

    Merged areas are added up before the rate is taken; areas that were split pass
    their rate on (``split=None`` leaves them out).
    """
    units = housing_2010(housing, codes)
    rates = merge_keys(units, "GEOID", merged, ["HU_VAC", "HU_TOT"]).select(
        "GEOID", percent("HU_VAC", "HU_TOT").alias(out)
    )
    return rates if split is None else replicate_keys(rates, "GEOID", split)
