"""Pre-census estimates per county, with broadband access."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.constants import (
    BROADBAND_CODES,
    GROUP_SOURCES,
    GROUPS,
    PARENT_NAMES,
    ROLLED_UP_AREAS,
    SPLIT_AREAS,
)
from geopanel.functions import sql
from geopanel.operators.compare import interpolate
from geopanel.operators.crosswalk import Members, replicate_keys, roll_up
from geopanel.operators.joins import attach_one_row
from geopanel.operators.series import percent_of_base
from geopanel.sources.coded import select_codes

_GROUP_ORDER = ["NH_WA", "NH_BA", "H_TOT", "NH_AI", "NH_AA", "NH_NA", "NH_TOM"]


def group_totals(prefix: str = "", groups=tuple(GROUPS)):
    """Male plus female per population group."""
    return [
        sql("CAST({m} + {f} AS BIGINT)", m=f"{GROUP_SOURCES[g]}_MALE",
            f=f"{GROUP_SOURCES[g]}_FEMALE").alias(f"{prefix}{g}_TOT")
        for g in groups
    ]


def broadband(county: DataFrame, national: DataFrame, split: Members) -> DataFrame:
    """Share of households with broadband per area, the national share beside it."""
    part, base = list(BROADBAND_CODES.values())
    rates = percent_of_base(
        county, ["GEOID"], "variable", "estimate", part, base, "PCT_HH_BROADBAND"
    )
    overall = percent_of_base(
        national, [], "variable", "estimate", part, base, "PCT_HH_BROADBAND_NATIONAL"
    )
    return attach_one_row(replicate_keys(rates, "GEOID", split), overall)


def estimates(
    characteristics: DataFrame, housing: DataFrame, components: DataFrame,
    survey_county: DataFrame, survey_national: DataFrame,
    rolled_up: Mapping[str, Sequence[str]] = ROLLED_UP_AREAS, split: Members = SPLIT_AREAS,
    parent_names: Mapping[str, tuple[str, str]] = PARENT_NAMES, compat: bool = False,
) -> DataFrame:
    """One row per area, plus one row per rolled-up area of the older geography.

    A rolled-up row takes its names from ``parent_names`` (key -> state name, county
    name), and those of its first member where it is not listed or with ``compat``.
    The survey tables carry the variables under their names, not their codes.
    """
    county_level = F.col("SUMLEV") == "050"
    key = F.concat("STATE", "COUNTY").alias("GEOID")
    people = characteristics.filter(
        county_level & (F.col("AGEGRP") == 0) & (F.col("YEAR") == 13)
    ).select(
        "STNAME", "CTYNAME", key, F.col("TOT_POP").alias("EST_POP_TOT"),
        *group_totals("EST_", _GROUP_ORDER),
    )
    units = housing.filter(county_level).select(key, F.col("HUESTIMATE042020").alias("EST_HU_TOT"))
    quarters = components.filter(county_level).select(
        key, interpolate("GQESTIMATES2019", "GQESTIMATES2020").alias("EST_GQ_TOT")
    )
    areas = people.join(units, "GEOID", "left").join(quarters, "GEOID", "left")
    figures = [c for c in areas.columns if c.startswith("EST_")]
    names = ("STNAME", "CTYNAME")
    known = {} if compat else {k: v for k, v in parent_names.items() if k in rolled_up}
    both = roll_up(
        areas, "GEOID", rolled_up, mark="__older",
        labels={c: {k: pair[at] for k, pair in known.items()} for at, c in enumerate(names)},
    )
    unnamed = {k: codes for k, codes in rolled_up.items() if k not in known}
    if unnamed:
        both = _named_by_member(both, people.select("GEOID", *names), names, unnamed)
    access = broadband(survey_county, survey_national, split)
    return both.join(access, "GEOID", "left").select(
        *names, "GEOID", *figures, F.when(F.col("__older"), 2019).otherwise(2020).alias("GEOYEAR"),
        "PCT_HH_BROADBAND", "PCT_HH_BROADBAND_NATIONAL",
    )


def _named_by_member(
    both: DataFrame, areas: DataFrame, names: Sequence[str], parents: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Rolled-up rows of ``parents`` with the names of their first member there is.

    The first member is found by its place in the sorted list, a number, and only the
    few member rows are looked at.
    """
    places = [(p, c, n) for p, codes in parents.items() for n, c in enumerate(sorted(codes))]
    listed = F.explode(F.array(*[
        F.struct(F.lit(p).alias("__parent"), F.lit(c).alias("__code"), F.lit(n).alias("__at"))
        for p, c, n in places
    ]))
    members = areas.filter(F.col("GEOID").isin(sorted({c for _, c, _ in places}))).withColumn(
        "__p", listed).filter("GEOID = __p.__code").select("__p.*", *names)
    first = members.groupBy("__parent").agg(F.min("__at").alias("__at"))
    chosen = members.join(first, ["__parent", "__at"]).select(
        "__parent", *[F.col(c).alias(f"__{c}") for c in names])
    joined = both.join(
        chosen, F.col("__older") & (F.col("GEOID") == F.col("__parent")), "left")
    return joined.select(
        *[F.coalesce(c, f"__{c}").alias(c) if c in names else F.col(c) for c in both.columns])


def survey_by_name(survey: DataFrame) -> DataFrame:
    """Survey rows of the broadband codes under their names."""
    return select_codes(survey, BROADBAND_CODES)
