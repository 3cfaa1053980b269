"""Tables that put national context beside each area."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.constants import ROLLED_UP_AREAS
from geopanel.functions import as_number, pad_key, remove_first_text
from geopanel.operators.crosswalk import Members, roll_up
from geopanel.operators.enrich import clean_titles
from geopanel.operators.joins import attach_context
from geopanel.operators.series import (
    decode_series,
    densify,
    stack_vintages,
    week_range,
    weekly_sample,
)

YEAR_2020 = (dt.date(2020, 1, 1), dt.date(2021, 1, 1))


def covid_weekly(
    areas: DataFrame, national: DataFrame, county: DataFrame,
    after: dt.date = YEAR_2020[0], before: dt.date = YEAR_2020[1],
    rolled_up: Members = ROLLED_UP_AREAS, compat: bool = False,
) -> DataFrame:
    """Average daily cases per 100k on every Sunday for every area.

    ``areas`` has ``fips``. The rolled-up area adds its members' rates; the national
    rate beside it is kept, or added up as well with ``compat``.
    """
    keys = areas.select(pad_key("fips", 5).alias("geoid"))
    overall, local = "national_cases_avg_per_100k", "county_cases_avg_per_100k"
    weeks = weekly_sample(national, "date", after, before).select(
        "date", F.col("cases_avg_per_100k").alias(overall)
    )
    facts = weekly_sample(county, "date", after, before).select(
        remove_first_text("geoid", "USA-").alias("geoid"), "date",
        F.col("cases_avg_per_100k").alias(local),
    )
    dense = densify(keys, weeks, facts, "geoid", "date", week_range(after, before))
    dense = dense.select("geoid", "date", overall, local)
    if compat:
        return roll_up(dense, "geoid", rolled_up, by=["date"])
    return roll_up(
        dense, "geoid", rolled_up, by=["date"], columns=[local],
        extra={overall: F.max(overall)},
    )


def response_rates(
    county: DataFrame | Sequence[tuple[DataFrame, int]],
    national: DataFrame | Sequence[tuple[DataFrame, int]],
    rolled_up: Members = ROLLED_UP_AREAS, weight: str | None = None,
) -> DataFrame:
    """Self-response rate per area and census year, the national rate beside it.

    Each frame holds text columns ``rate`` and, for counties, ``state`` and
    ``county``; it comes with its year, or one frame holds all vintages with a column
    ``year``. An area may occur once a year. A national year without county rows keeps
    its row.
    """
    figure, overall = "county-response-rate", "us-response-rate"

    def vintages(frames):
        return frames if isinstance(frames, DataFrame) else stack_vintages(frames)

    local = vintages(county).select(
        pad_key(F.concat("state", "county"), 5).alias("GEOID"), "year",
        as_number("rate").alias(figure), *([weight] if weight else []),
    )
    us = vintages(national).select("year", as_number("rate").alias(overall))
    joined = attach_context(local, us, "year", keep_unmatched=True)
    rolled = roll_up(
        joined, "GEOID", rolled_up, by=["year"], how="mean", weight=weight,
        columns=[figure, overall],
    )
    return rolled.select("GEOID", "year", figure, overall)


def unemployment(
    series: DataFrame, national: DataFrame, year: int = 2020, compat: bool = False
) -> DataFrame:
    """Monthly unemployment rate per county, the national rate beside it.

    ``compat`` takes six characters of the series id as area code instead of five.
    """
    local = decode_series(
        series, year, area_width=6 if compat else 5, out="county_unemployment_rate"
    )
    return attach_context(local, national, "month").select(
        "GEOID", "month", "county_unemployment_rate", "national_unemployment_rate"
    )


def disasters(declarations: DataFrame) -> DataFrame:
    """Disaster declarations with readable titles."""
    return clean_titles(declarations)
