"""Build one published table from files.

    spark-submit -m geopanel.run county_pl --population P --housing H --codes C --out OUT

Inputs are CSV (``.txt`` is tab-separated, ``.json`` an array of arrays) or Parquet by
their suffix. ``--format parquet`` suits tables that feed another table.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from geopanel import constants as K
from geopanel import plans
from geopanel.operators.categories import race_groups
from geopanel.session import build_session
from geopanel.sources import schemas as S
from geopanel.sources.coded import read_decennial, read_survey
from geopanel.sources.delimited import read_csv, read_tsv, write_csv
from geopanel.sources.header_json import read_header_json


def _rates(column: str, local: bool) -> dict[str, str]:
    places = {"state": "state", "county": "county"} if local else {}
    return {"rate": column, **places}


# Rate columns of the two census years.
RATE_COLUMNS = {2020: "CRRALL", 2010: "FSRR2010"}


@dataclass(frozen=True)
class Coded:
    """A long table of which only the listed codes are read (and renamed, if mapped)."""

    read: Callable[..., DataFrame]
    codes: Sequence[str] | Mapping[str, str]


RACE_CODES = sorted({c for items in race_groups().values() for c in items})


@dataclass(frozen=True)
class Table:
    """Inputs (option name -> column contract) and how they become the table."""

    build: Callable[..., DataFrame]
    inputs: dict[str, S.Contract | tuple[str, bool] | Coded]
    has_compat: bool = False
    help: str = ""
    encodings: dict[str, str] = field(default_factory=dict)


def _estimates(
    characteristics, housing, components, survey_county, survey_national, compat=False
):
    return plans.estimates(
        characteristics, housing, components, survey_county, survey_national, compat=compat,
    )


def _response_rates(county_2020, county_2010, national_2020, national_2010):
    return plans.response_rates(
        [(county_2020, 2020), (county_2010, 2010)],
        [(national_2020, 2020), (national_2010, 2010)],
    )


LATIN = "ISO-8859-1"
TABLES: dict[str, Table] = {
    "county_pl": Table(
        plans.county_pl,
        {"population": Coded(read_decennial, RACE_CODES),
         "housing": Coded(read_decennial, list(K.HOUSING_CODES)), "codes": S.AREA_CODES},
        help="counts by area with reallocated race categories",
    ),
    "estimates": Table(
        _estimates,
        {"characteristics": S.CHARACTERISTICS_2020, "housing": S.HOUSING_2020,
         "components": S.COMPONENTS_2020,
         "survey_county": Coded(read_survey, K.BROADBAND_CODES),
         "survey_national": Coded(read_survey, K.BROADBAND_CODES)},
        has_compat=True, help="estimates by area with broadband access",
        encodings={"characteristics": LATIN, "components": LATIN, "housing": LATIN},
    ),
    "cutpoints": Table(
        plans.cutpoints,
        {"characteristics_est": S.CHARACTERISTICS_2010, "housing_est": S.HOUSING_2010,
         "components": S.COMPONENTS_2010, "characteristics_cen": S.CHARACTERISTICS_2012,
         "quarters_cen": Coded(read_decennial, list(K.GQ_CODES_2010)),
         "housing_cen": Coded(read_decennial, list(K.HOUSING_CODES_2010))},
        help="calibrated bands by metric and size class",
        encodings={"characteristics_est": LATIN, "characteristics_cen": LATIN,
                   "components": LATIN, "housing_est": LATIN},
    ),
    "vacancy_2010": Table(
        plans.vacancy_2010, {"housing": Coded(read_decennial, list(K.HOUSING_CODES_2010))},
        help="2010 vacancy by area",
    ),
    "county_main": Table(
        plans.county_main,
        {"counts": S.COUNTY_PL, "estimates": S.ESTIMATES, "bands": S.CUTPOINTS,
         "housing_2010_long": Coded(read_decennial, list(K.VACANCY_CODES_2010))},
        has_compat=True, help="counts beside estimates, differences and grades",
    ),
    "covid_weekly": Table(
        plans.covid_weekly,
        {"areas": {"fips": "string"}, "national": S.DAILY_CASES,
         "county": S.COUNTY_DAILY_CASES},
        has_compat=True, help="weekly case rates of 2020 by area",
    ),
    "response_rates": Table(
        _response_rates,
        {f"{level}_{year}": (column, level == "county")
         for level in ("county", "national") for year, column in RATE_COLUMNS.items()},
        help="self-response rates by area and census year",
    ),
    "unemployment": Table(
        plans.unemployment, {"series": S.LABOUR_SERIES, "national": S.MONTHLY_RATE},
        has_compat=True, help="monthly unemployment rates of 2020 by area",
    ),
    "disasters": Table(
        plans.disasters, {"declarations": S.DISASTERS}, help="disaster declarations by area",
    ),
}


def read_input(
    spark: SparkSession, path: str, contract, layout: str, encoding: str = "UTF-8"
) -> DataFrame:
    if isinstance(contract, tuple):
        return read_header_json(spark, path, _rates(*contract), layout)
    if isinstance(contract, Coded):
        return contract.read(spark, path, contract.codes, encoding=encoding)
    bare = path.rstrip("/")
    if bare.endswith(".parquet"):
        return spark.read.parquet(path).select(*contract)
    if bare.endswith((".txt", ".tsv")):
        return read_tsv(spark, path, contract)
    return read_csv(spark, path, contract, encoding=encoding)


def build(
    spark: SparkSession, name: str, paths: dict[str, str], compat: bool = False,
    layout: str = "rows", encoding: str | None = None,
) -> DataFrame:
    """The table as a frame; ``paths`` holds one path per input."""
    table = TABLES[name]
    frames = {
        key: read_input(
            spark, paths[key], contract, layout,
            encoding or table.encodings.get(key, "UTF-8"),
        )
        for key, contract in table.inputs.items()
    }
    return table.build(**frames, **({"compat": compat} if table.has_compat else {}))


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="geopanel.run")
    commands = out.add_subparsers(dest="table", required=True)
    for name, table in TABLES.items():
        command = commands.add_parser(name, help=table.help)
        for key in table.inputs:
            command.add_argument(f"--{key.replace('_', '-')}", required=True, dest=key)
        command.add_argument("--out", required=True)
        command.add_argument("--format", choices=["csv", "parquet"], default="csv")
        command.add_argument("--mode", default="errorifexists")
        command.add_argument("--encoding", help="of the CSV inputs")
        command.add_argument("--json-layout", choices=["rows", "free", "documents"], default="rows")
        if table.has_compat:
            command.add_argument("--compat", action="store_true",
                                 help="reproduce the scripted behaviour quirk by quirk")
    return out


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = spark or build_session(f"geopanel {options.table}")
    table = build(
        spark, options.table, {k: getattr(options, k) for k in TABLES[options.table].inputs},
        getattr(options, "compat", False), options.json_layout, options.encoding,
    )
    if options.format == "parquet":
        table.write.mode(options.mode).parquet(options.out)
    else:
        write_csv(table, options.out, options.mode)


if __name__ == "__main__":
    main()
