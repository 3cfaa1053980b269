"""Benchmark tables, and the area panel most queries derive from line items.

The panel gives every part an estimate (shipped before mid 1998) and a count
(shipped after) of: quantity as population, quantity per line number as the seven
groups, lines as housing units, returned-and-filled quantity as group quarters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.constants import GROUPS
from geopanel.functions import number_key
from geopanel.operators.compare import household, per_unit, share_columns, size_class

CUT = "1998-07-01"
SIZES = [(450, "Large"), (350, "Medium"), (None, "Small")]
SOURCES = ("EST", "CEN")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def area_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part, 20 counts; one scan of four columns, one aggregation."""
    early = f"l_shipdate < TIMESTAMP_NTZ '{CUT}'"
    counts = []
    for source, rows in (("EST", early), ("CEN", f"NOT {early}")):
        quantity = {
            "POP_TOT": rows,
            **{f"{g}_TOT": f"{rows} AND l_linenumber = {i}" for i, g in enumerate(GROUPS, 1)},
        }
        counts += [
            F.expr(f"bigint(sum(l_quantity) FILTER (WHERE {where}))").alias(f"{source}_{m}")
            for m, where in quantity.items()
        ]
        returned = f"{rows} AND l_returnflag = 'R' AND l_linestatus = 'F'"
        counts += [
            F.expr(f"count_if({rows})").alias(f"{source}_HU_TOT"),
            F.expr(f"bigint(coalesce(sum(l_quantity) FILTER (WHERE {returned}), 0))")
            .alias(f"{source}_GQ_TOT"),
        ]
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("area")).agg(*counts)


def graded_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with shares, persons per unit and size class."""
    new = {}
    for s in SOURCES:
        new |= share_columns(f"{s}_", GROUPS, f"{s}_POP_TOT")
        new[f"{s}_HH_TOT"] = household(f"{s}_POP_TOT", f"{s}_GQ_TOT")
        new[f"{s}_PPH_RAT"] = per_unit(f"{s}_POP_TOT", f"{s}_GQ_TOT", f"{s}_HU_TOT")
    new["SIZE_CLASS"] = size_class("CEN_POP_TOT", SIZES)
    return area_panel(spark, sf_dir).withColumns(new)


def labour_series(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """Monthly series per supplier and line number of one year, ids built after adding up.

    December rows flagged A stand for the annual average. The year is a range over the
    bare date, so that it reaches the scan.
    """
    first, last = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    month = F.month("l_shipdate")
    annual = (F.col("l_returnflag") == "A") & (month == 12)
    items = table(spark, sf_dir, "lineitem").filter(
        (F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last)
    )
    sums = items.groupBy(
        "l_suppkey", "l_linenumber", F.year("l_shipdate").alias("year"),
        F.when(annual, 13).otherwise(month).alias("month"),
    ).agg(F.sum("l_quantity").alias("value"))
    return sums.select(
        F.concat(
            F.lit("LAUCN"), number_key("l_suppkey", 5), F.lit("00000000"),
            number_key("l_linenumber", 2),
        ).alias("series_id"),
        "year", F.concat(F.lit("M"), number_key("month", 2)).alias("period"), "value",
    )


# --- The same in SQL ----------------------------------------------------------

_PERIOD = {"EST": f"l_shipdate < TIMESTAMP '{CUT}'", "CEN": f"l_shipdate >= TIMESTAMP '{CUT}'"}


def _sum(where: str) -> str:
    return f"CAST(sum(l_quantity) FILTER (WHERE {where}) AS BIGINT)"


PANEL_SQL = "panel AS (SELECT l_partkey AS area, " + ", ".join(
    ", ".join([
        f"{_sum(p)} AS {s}_POP_TOT",
        *[f"{_sum(f'{p} AND l_linenumber = {i}')} AS {s}_{g}_TOT"
          for i, g in enumerate(GROUPS, start=1)],
        f"count(*) FILTER (WHERE {p}) AS {s}_HU_TOT",
        "coalesce(" + _sum(f"{p} AND l_returnflag = 'R' AND l_linestatus = 'F'")
        + f", 0) AS {s}_GQ_TOT",
    ])
    for s, p in _PERIOD.items()
) + " FROM lineitem GROUP BY l_partkey)"

SIZED_SQL = PANEL_SQL + ", sized AS (SELECT *, " + ", ".join(
    ", ".join([
        *[f"{s}_{g}_TOT / nullif({s}_POP_TOT, 0) AS {s}_{g}_PROP" for g in GROUPS],
        f"{s}_POP_TOT - {s}_GQ_TOT AS {s}_HH_TOT",
        f"({s}_POP_TOT - {s}_GQ_TOT) / nullif({s}_HU_TOT, 0) AS {s}_PPH_RAT",
    ])
    for s in SOURCES
) + """, CASE WHEN CEN_POP_TOT >= 450 THEN 'Large' WHEN CEN_POP_TOT >= 350 THEN 'Medium'
  WHEN CEN_POP_TOT IS NOT NULL THEN 'Small' END AS SIZE_CLASS FROM panel)"""


def long_sql(metrics, name: str = "long", source: str = "sized", kind: str = "DOUBLE") -> str:
    cells = ", ".join(
        f"{{'variable': '{m}', 'EST': CAST(EST_{m} AS {kind}), 'CEN': CAST(CEN_{m} AS {kind})}}"
        for m in metrics
    )
    return (
        f"{name} AS (SELECT area, SIZE_CLASS, c.variable, c.EST, c.CEN FROM "
        f"(SELECT area, SIZE_CLASS, unnest([{cells}]) AS c FROM {source}))"
    )
