"""The published tables, assembled from the operators.

Each function takes input DataFrames and returns one lazy DataFrame.
"""
from geopanel.plans.calibration import cutpoints, vacancy_2010
from geopanel.plans.context import covid_weekly, disasters, response_rates, unemployment
from geopanel.plans.counts import county_pl
from geopanel.plans.estimates import estimates
from geopanel.plans.grading import county_main

__all__ = [
    "county_main", "county_pl", "covid_weekly", "cutpoints", "disasters", "estimates",
    "response_rates", "unemployment", "vacancy_2010",
]
