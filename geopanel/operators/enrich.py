"""Names, notes, titles and record selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.constants import EXCLUDED_STATE, FEMA_COLUMNS
from geopanel.functions import alias_code, title_case
from geopanel.operators.joins import full_join, left_lookup
from geopanel.operators.reshape import common_type, to_long


def area_names(df: DataFrame, key: str, codes: DataFrame) -> DataFrame:
    """Add state abbreviation and county name from an area-code table."""
    lookup = codes.select(
        F.concat("state_code", "county_code").alias("__code"),
        F.col("state").alias("stabbrev"),
        F.col("county").alias("countynm"),
    )
    return left_lookup(df, lookup, {key: "__code"})


def repair_names(name: str, renames: Mapping[str, str]) -> Column:
    """Rename listed values, keep the rest."""
    return F.coalesce(alias_code(name, renames), F.col(name))


def notes(key: str, texts: Mapping[str, str]) -> Column:
    """Note of a listed key, empty text for all others."""
    return F.coalesce(alias_code(key, texts), F.lit(""))


def clean_titles(
    df: DataFrame, title: str = "declarationTitle", columns: Sequence[str] = tuple(FEMA_COLUMNS)
) -> DataFrame:
    """Title-case one column and keep the output columns."""
    return df.withColumn(title, title_case(title)).select(*columns)


def outside_state(key: str, state: str | None = EXCLUDED_STATE) -> Column:
    """Keys of other states (all but NULL without one); reaches the scan as a pushed filter."""
    return F.col(key).isNotNull() if state is None else ~F.col(key).startswith(state)


def compare_long(
    estimates: DataFrame, counts: DataFrame, ids: Sequence[str], columns: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Two wide tables as one long panel ``(ids, keep, variable, EST, CEN)``.

    Joining the wide rows first and unpivoting after gives the rows of a full join
    of the two long forms on (ids, variable), with one join row per area.
    """
    left = estimates.select(*ids, *[F.col(c).alias(f"EST_{c}") for c in columns])
    right = counts.select(*ids, *keep, *[F.col(c).alias(f"CEN_{c}") for c in columns])
    wide = full_join(left, right, ids)
    kind = common_type(wide, [f"{s}_{c}" for s in ("EST", "CEN") for c in columns])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("variable"),
            F.col(f"EST_{c}").cast(kind).alias("EST"),
            F.col(f"CEN_{c}").cast(kind).alias("CEN"),
        )
        for c in columns
    ])
    return wide.select(*ids, *keep, F.inline(rows))


def join_long(
    estimates: DataFrame, counts: DataFrame, ids: Sequence[str], columns: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """As ``compare_long`` for two tables that carry different columns."""
    est = to_long(estimates, ids, [c for c in columns if c in estimates.columns], value="EST")
    cen = to_long(
        counts, [*ids, *keep], [c for c in columns if c in counts.columns], value="CEN"
    )
    return full_join(est, cen, [*ids, "variable"])
