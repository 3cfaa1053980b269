"""Column contracts of the input files: name -> Spark type, used columns only.

Codes are always text (leading zeros matter); counts are BIGINT, rates DOUBLE.
"""

from __future__ import annotations

from geopanel.constants import CUTPOINT_COLUMNS, FEMA_COLUMNS, GROUP_SOURCES, HOUSING_CODES

Contract = dict[str, str]

_SEXES = ("MALE", "FEMALE")
_GROUP_COUNTS: Contract = {
    f"{source}_{sex}": "bigint" for source in GROUP_SOURCES.values() for sex in _SEXES
}
_CHARACTERISTICS: Contract = {
    "STNAME": "string", "CTYNAME": "string", "YEAR": "int", "AGEGRP": "int",
    "TOT_POP": "bigint", **_GROUP_COUNTS,
}

CHARACTERISTICS_2010: Contract = {"STATE": "int", "COUNTY": "int", **_CHARACTERISTICS}
CHARACTERISTICS_2012: Contract = {"STATE": "string", "COUNTY": "string", **_CHARACTERISTICS}
CHARACTERISTICS_2020: Contract = {"SUMLEV": "string", **CHARACTERISTICS_2012}
COMPONENTS_2010: Contract = {
    "SUMLEV": "string", "STATE": "string", "COUNTY": "string", "STNAME": "string",
    "CTYNAME": "string", "GQESTIMATES2009": "bigint", "GQESTIMATES2010": "bigint",
}
COMPONENTS_2020: Contract = {
    "SUMLEV": "string", "STATE": "string", "COUNTY": "string",
    "GQESTIMATES2019": "bigint", "GQESTIMATES2020": "bigint",
}
HOUSING_2010: Contract = {
    "sumlev": "string", "state": "string", "county": "string", "huest_042010": "bigint",
}
HOUSING_2020: Contract = {
    "SUMLEV": "string", "STATE": "string", "COUNTY": "string", "HUESTIMATE042020": "bigint",
}
DECENNIAL_LONG: Contract = {
    "GEOID": "string", "NAME": "string", "variable": "string", "value": "bigint",
}
SURVEY_LONG: Contract = {
    "GEOID": "string", "NAME": "string", "variable": "string",
    "estimate": "double", "moe": "double",
}
AREA_CODES: Contract = {
    "state_code": "string", "county_code": "string", "state": "string", "county": "string",
}
DAILY_CASES: Contract = {
    "date": "date", "geoid": "string", "cases": "bigint", "cases_avg": "double",
    "cases_avg_per_100k": "double", "deaths": "bigint", "deaths_avg": "double",
    "deaths_avg_per_100k": "double",
}
COUNTY_DAILY_CASES: Contract = {
    "date": "date", "geoid": "string", "cases_avg_per_100k": "double",
}
LABOUR_SERIES: Contract = {
    "series_id": "string", "year": "int", "period": "string", "value": "double",
}
MONTHLY_RATE: Contract = {"month": "string", "national_unemployment_rate": "double"}
DISASTERS: Contract = {c: "string" for c in FEMA_COLUMNS}
CUTPOINTS: Contract = {
    c: {"variable": "string", "SIZE_CLASS": "string", "count": "bigint"}.get(c, "double")
    for c in CUTPOINT_COLUMNS
}
LINKS: Contract = {"Name": "string", "Type": "string", "Link": "string"}

COUNTY_PL: Contract = {
    "fips": "string", "stabbrev": "string", "countynm": "string",
    **{c: "bigint" for c in (
        "total_all_all", "all_hisp_all", "white_all_all", "black_all_all", "aian_all_all",
        "asian_all_all", "nhpi_all_all", "twoplus_all_all",
    )},
    **{c: "bigint" for c in HOUSING_CODES.values()},
}
ESTIMATES: Contract = {
    "STNAME": "string", "CTYNAME": "string", "GEOID": "string",
    **{c: "bigint" for c in (
        "EST_POP_TOT", "EST_NH_WA_TOT", "EST_NH_BA_TOT", "EST_H_TOT_TOT", "EST_NH_AI_TOT",
        "EST_NH_AA_TOT", "EST_NH_NA_TOT", "EST_NH_TOM_TOT", "EST_HU_TOT", "EST_GQ_TOT",
    )},
    "GEOYEAR": "int",
    "PCT_HH_BROADBAND": "double", "PCT_HH_BROADBAND_NATIONAL": "double",
}
POLYGONS: Contract = {
    "GEOID": "string", "parts": "array<array<array<struct<x:double,y:double>>>>",
}


def ddl(contract: Contract) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in contract.items())
