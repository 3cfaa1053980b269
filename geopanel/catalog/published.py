"""The published tables, over inputs of their shape derived from the benchmark tables.

Areas are parts or suppliers; area codes are their keys as zero-padded text. Code
changes that happen in the real data are replaced by changes between those keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from geopanel import plans
from geopanel.catalog.bands import _BANDS, _BANDS_OUT, _DIFFS, METRICS
from geopanel.catalog.inputs import (
    SIZED_SQL,
    SIZES,
    area_panel,
    graded_panel,
    labour_series,
    long_sql,
    table,
)
from geopanel.catalog.registry import query
from geopanel.constants import (
    AREA_NOTES,
    BROADBAND_CODES,
    CATEGORY_ITEMS,
    CLOSE,
    COUNT_ALIASES,
    COUNTY_MAIN_COLUMNS,
    DIFF_METRICS,
    GROUP_SOURCES,
    GROUPS,
    HIGH,
    HOUSING_CODES,
    MEASURE_NAMES,
    REALLOCATION_FACTORS,
    RELATIVE_METRICS,
    SLIGHT,
    ZERO_IF_ACTUAL_ZERO,
)
from geopanel.functions import number_key
from geopanel.operators.bands import calibrate_bands
from geopanel.operators.reshape import to_long
from geopanel.plans.estimates import survey_by_name

ROLLED_UP = {"90001": ["00011", "00012"], "90002": ["00012", "00013"]}
MERGED = {"00003": "00007", "00004": "00007"}
SPLIT = {"00020": ["90001", "90003"]}

_ROLLED_SQL = """(VALUES ('90001', '00011'), ('90001', '00012'), ('90002', '00012'),
    ('90002', '00013')) m(parent, member)"""


def _pad(column: str, width: int = 5) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def _qty(where: str) -> str:
    return f"CAST(sum(l_quantity) FILTER (WHERE {where}) AS BIGINT)"


def _quantity(condition):
    return F.sum(F.when(condition, F.col("l_quantity"))).cast("bigint")


def _shipped(after: str | None, before: str | None):
    day, out = F.col("l_shipdate"), F.lit(True)
    if after:
        out = out & (day >= F.lit(after).cast("timestamp_ntz"))
    if before:
        out = out & (day < F.lit(before).cast("timestamp_ntz"))
    return out


# --- County counts ------------------------------------------------------------

_CATEGORIES = ", ".join(
    f"CASE WHEN count(*) FILTER (WHERE item IN ({items})) = {n} THEN "
    f"CAST(sum(v) FILTER (WHERE item IN ({items})) AS BIGINT) END AS {name}"
    for name, items, n in (
        (k, ", ".join(map(str, v)), len(v)) for k, v in CATEGORY_ITEMS.items()
    )
)
_PARTS = ", ".join(
    f"CAST(round_even(sor_alone * {f}::DOUBLE, 0) AS BIGINT) AS {g}_sor"
    for g, f in REALLOCATION_FACTORS.items()
)
_PIECES = " + ".join(f"{g}_sor" for g in REALLOCATION_FACTORS)
_HOUSING = ", ".join(
    f"max(v) FILTER (WHERE code = {i}) AS {name}"
    for i, name in enumerate(HOUSING_CODES.values())
)


@query(f"""WITH people AS (SELECT {_pad('l_suppkey')} AS fips, l_orderkey % 73 + 1 AS item,
    CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem WHERE l_returnflag IN ('N', 'R')
    GROUP BY ALL),
  units AS (SELECT {_pad('l_suppkey')} AS fips, l_partkey % 13 AS code,
    CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY ALL),
  cats AS (SELECT fips, {_CATEGORIES} FROM people GROUP BY fips),
  parts AS (SELECT *, {_PARTS} FROM cats),
  races AS (SELECT fips, total_all_all, all_hisp_all,
    white_alone + white_sor - ({_PIECES} - sor_alone) AS white_all_all,
    black_alone + black_sor AS black_all_all, aian_alone + aian_sor AS aian_all_all,
    asian_alone + asian_sor AS asian_all_all, nhpi_alone + nhpi_sor AS nhpi_all_all,
    multi_race + multi_sor AS twoplus_all_all FROM parts),
  housing AS (SELECT fips, {_HOUSING} FROM units GROUP BY fips)
  SELECT r.fips, n_name AS stabbrev, s_name AS countynm, r.* EXCLUDE (fips),
    housing.* EXCLUDE (fips) FROM races r FULL JOIN housing ON r.fips = housing.fips
  LEFT JOIN supplier ON {_pad('s_suppkey')} = r.fips
  LEFT JOIN nation ON n_nationkey = s_nationkey WHERE NOT starts_with(r.fips, '0007')""")
def county_pl(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    key = number_key("l_suppkey", 5)

    def long(rows, code, variable):
        """Added up per area and number first, spelled out as codes afterwards."""
        sums = rows.groupBy("l_suppkey", *code).agg(
            F.sum("l_quantity").cast("bigint").alias("value")
        )
        return sums.select(
            key.alias("GEOID"), F.concat(F.lit("Area "), key).alias("NAME"),
            variable.alias("variable"), "value",
        )

    digit = F.when(F.col("l_returnflag").isin("N", "R"), "2").otherwise("4")
    population = long(
        items, [digit.alias("digit"), (F.col("l_orderkey") % 73 + 1).alias("item")],
        F.concat(F.lit("P"), "digit", F.lit("_"), number_key("item", 3), F.lit("N")),
    )
    codes = F.array(*[F.lit(c) for c in HOUSING_CODES])
    housing = long(
        items,
        [(F.col("l_partkey") % 13).cast("int").alias("place")], F.get(codes, F.col("place")),
    )
    supplier, nation = (table(spark, sf_dir, t) for t in ("supplier", "nation"))
    padded = number_key("s_suppkey", 5)
    names = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.substring(padded, 1, 2).alias("state_code"),
        F.substr(padded, F.lit(3)).alias("county_code"),
        F.col("n_name").alias("state"), F.col("s_name").alias("county"),
    )
    return plans.county_pl(population, housing, names, excluded_state="0007")


# --- Estimates ----------------------------------------------------------------

_SEX = {"MALE": "O", "FEMALE": "F"}


def _people(items, rows):
    """Total and counts by group and sex, one row per part."""
    return items.filter(rows).groupBy("l_partkey").agg(
        F.expr("bigint(sum(l_quantity))").alias("TOT_POP"),
        *[
            F.expr(
                "bigint(coalesce(sum(l_quantity) FILTER "
                f"(WHERE l_linenumber = {i} AND l_linestatus = '{s}'), 0))"
            ).alias(f"{GROUP_SOURCES[g]}_{sex}")
            for i, g in enumerate(GROUPS, 1) for sex, s in _SEX.items()
        ],
    )


def _group_sql(prefix: str) -> str:
    return ", ".join(
        f"coalesce({_qty(f'l_linenumber = {i}')}, 0) AS {prefix}{g}_TOT"
        for i, g in enumerate(GROUPS, 1)
    )


_EST_FIGURES = ["EST_POP_TOT", *[f"EST_{g}_TOT" for g in GROUPS], "EST_HU_TOT", "EST_GQ_TOT"]
_STRICT_SUMS = ", ".join(
    f"CASE WHEN count({c}) = count(*) THEN CAST(sum({c}) AS BIGINT) END AS {c}"
    for c in _EST_FIGURES
)


@query(f"""WITH people AS (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS EST_POP_TOT,
    {_group_sql('EST_')} FROM lineitem
    WHERE l_shipdate < TIMESTAMP '1998-07-01' AND l_returnflag <> 'A' GROUP BY 1),
  units AS (SELECT l_partkey, count(*) AS EST_HU_TOT FROM lineitem GROUP BY 1),
  gq AS (SELECT l_partkey, {_qty('year(l_shipdate) = 1997')} AS g1,
    {_qty('year(l_shipdate) = 1998')} AS g2 FROM lineitem GROUP BY 1),
  areas AS (SELECT p_brand AS STNAME, p_name AS CTYNAME, {_pad('p_partkey')} AS GEOID,
    people.* EXCLUDE (l_partkey), EST_HU_TOT,
    CAST(round_even(g1 + (g2 - g1) / 12 * 9, 0) AS BIGINT) AS EST_GQ_TOT
    FROM people JOIN part ON p_partkey = people.l_partkey
    LEFT JOIN units ON units.l_partkey = p_partkey LEFT JOIN gq ON gq.l_partkey = p_partkey
    WHERE p_size < 50),
  both_years AS (SELECT *, 2020 AS GEOYEAR FROM areas UNION ALL BY NAME
    SELECT min_by(STNAME, GEOID) AS STNAME, min_by(CTYNAME, GEOID) AS CTYNAME,
      parent AS GEOID, {_STRICT_SUMS}, 2019 AS GEOYEAR
    FROM areas JOIN {_ROLLED_SQL} ON member = GEOID GROUP BY parent),
  access AS (SELECT {_pad('l_partkey')} AS GEOID, sum(l_quantity) FILTER (WHERE
      l_discount >= 0.05) / nullif(sum(l_quantity), 0) * 100 AS pct FROM lineitem GROUP BY 1),
  spread AS (SELECT * FROM access UNION ALL SELECT v, pct FROM access,
    (VALUES ('90001'), ('90003')) t(v) WHERE GEOID = '00020')
  SELECT both_years.*, round(pct, 6) AS PCT_HH_BROADBAND,
    CASE WHEN spread.GEOID IS NOT NULL THEN round((SELECT sum(l_quantity) FILTER (WHERE
      l_discount >= 0.05) / sum(l_quantity) * 100 FROM lineitem), 6) END
      AS PCT_HH_BROADBAND_NATIONAL
  FROM both_years LEFT JOIN spread ON spread.GEOID = both_years.GEOID""")
def estimates(spark, sf_dir):
    items, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    key = number_key("l_partkey", 5)
    state, county = F.substring(key, 1, 2), F.substr(key, F.lit(3))
    names = part.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("STNAME"),
        F.col("p_name").alias("CTYNAME"),
        F.when(F.col("p_size") < 50, "050").otherwise("040").alias("SUMLEV"),
    )
    early, adult = _shipped(None, "1998-07-01"), F.col("l_returnflag") == "A"

    def people(rows, year, age):
        return _people(items, rows).withColumns({"YEAR": F.lit(year), "AGEGRP": F.lit(age)})

    characteristics = (
        people(early & ~adult, 13, 0).unionByName(people(early & adult, 13, 1))
        .unionByName(people(~early & ~adult, 12, 0))
        .join(names, "l_partkey").withColumns({"STATE": state, "COUNTY": county})
    )

    def county_level(*aggregates):
        return items.groupBy("l_partkey").agg(*aggregates).select(
            F.lit("050").alias("SUMLEV"), state.alias("STATE"), county.alias("COUNTY"), "*"
        )

    housing = county_level(F.count(F.lit(1)).alias("HUESTIMATE042020"))
    components = county_level(
        _quantity(_shipped("1997-01-01", "1998-01-01")).alias("GQESTIMATES2019"),
        _quantity(_shipped("1998-01-01", "1999-01-01")).alias("GQESTIMATES2020"),
    )
    part_code, base_code = BROADBAND_CODES
    served = F.sum(F.when(F.col("l_discount") >= 0.05, F.col("l_quantity"))).alias(part_code)
    everyone = F.sum("l_quantity").alias(base_code)

    def survey(grouped, ids):
        return survey_by_name(to_long(grouped, ids, [part_code, base_code], value="estimate"))

    return plans.estimates(
        characteristics, housing, components,
        survey(items.groupBy(key.alias("GEOID")).agg(served, everyone), ["GEOID"]),
        survey(items.agg(served, everyone), []),
        rolled_up=ROLLED_UP, split=SPLIT,
    )


# --- Calibration --------------------------------------------------------------


def _side_sql(source: str, period: str, units: str, quarters: str) -> str:
    shares = ", ".join(
        f"{source}_{g}_TOT / nullif({source}_POP_TOT, 0) AS {source}_{g}_PROP" for g in GROUPS
    )
    name = source.lower()
    return f"""{name}_people AS (SELECT l_partkey AS k, {_pad('l_partkey')} AS area,
      p_brand, p_name, CAST(sum(l_quantity) AS BIGINT) AS {source}_POP_TOT,
      {_group_sql(source + '_')} FROM lineitem JOIN part ON p_partkey = l_partkey
      WHERE {period} AND l_returnflag <> 'A' GROUP BY ALL),
    {name}_units AS (SELECT l_partkey AS k, {units} AS {source}_HU_TOT FROM lineitem
      WHERE {period} GROUP BY 1),
    {name}_gq AS (SELECT l_partkey AS k, {quarters} AS {source}_GQ_TOT FROM lineitem
      GROUP BY 1),
    {name}_joined AS (SELECT coalesce(area, {_pad('k')}) AS area, * EXCLUDE (k, area)
      FROM {name}_people FULL JOIN {name}_units USING (k) FULL JOIN {name}_gq USING (k)),
    {name} AS (SELECT *, {shares}, ({source}_POP_TOT - {source}_GQ_TOT)
      / nullif({source}_HU_TOT, 0) AS {source}_PPH_RAT FROM {name}_joined)"""


_CUT = f"""WITH {_side_sql(
    'EST', "l_shipdate < TIMESTAMP '1998-07-01'", 'count(*)',
    "CAST(round_even(" + _qty('year(l_shipdate) = 1996') + " + ("
    + _qty('year(l_shipdate) = 1997') + " - " + _qty('year(l_shipdate) = 1996')
    + ") / 12 * 9, 0) AS BIGINT)",
)}, {_side_sql(
    'CEN', "l_shipdate >= TIMESTAMP '1998-07-01'", 'count(*)',
    _qty('year(l_shipdate) = 1999'),
)}, sides AS (SELECT coalesce(est.area, cen.area) AS area, est.* EXCLUDE (area, p_brand, p_name),
    cen.* EXCLUDE (area, p_brand, p_name), CASE WHEN CEN_POP_TOT >= 300 THEN 'Large'
      WHEN CEN_POP_TOT >= 200 THEN 'Medium' WHEN CEN_POP_TOT IS NOT NULL THEN 'Small' END
      AS SIZE_CLASS
  FROM est FULL JOIN cen ON est.area = cen.area
    AND est.p_brand IS NOT DISTINCT FROM cen.p_brand
    AND est.p_name IS NOT DISTINCT FROM cen.p_name),
  {long_sql(METRICS, source='sides')}, {_DIFFS}, {_BANDS} """


@query(_CUT + _BANDS_OUT)
def cutpoints(spark, sf_dir):
    items, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    names = part.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("STNAME"),
        F.col("p_name").alias("CTYNAME"),
    )
    key = number_key("l_partkey", 5)
    early, adult = _shipped(None, "1998-07-01"), F.col("l_returnflag") == "A"
    county = {
        "SUMLEV": F.lit("050"), "sumlev_": F.lit("050"),
        "STATE": F.substring(key, 1, 2), "COUNTY": F.substr(key, F.lit(3)),
    }

    def people(rows, year):
        return _people(items, rows & ~adult).join(names, "l_partkey").withColumns(
            {"YEAR": F.lit(year), "AGEGRP": F.lit(0)}
        )

    def units(rows):
        return items.filter(rows).groupBy("l_partkey").agg(
            F.count(F.lit(1)).alias("n")
        )

    # The older file has numeric codes, the newer one padded text. Numbers keep no zeros in
    # front, so a longer key is cut before its last three digits: 100012 is 100 and 12.
    older = people(early, 13).withColumns({
        "STATE": F.left(key, F.length(key) - 3).cast("int"),
        "COUNTY": F.right(key, F.lit(3)).cast("int"),
    })
    newer = people(~early, 1).withColumns({k: county[k] for k in ("STATE", "COUNTY")})
    housing = units(early).select(
        F.lit("050").alias("sumlev"), county["STATE"].alias("state"),
        county["COUNTY"].alias("county"), F.col("n").alias("huest_042010"),
    )
    components = items.groupBy("l_partkey").agg(
        _quantity(_shipped("1996-01-01", "1997-01-01")).alias("GQESTIMATES2009"),
        _quantity(_shipped("1997-01-01", "1998-01-01")).alias("GQESTIMATES2010"),
    ).withColumns({k: county[k] for k in ("SUMLEV", "STATE", "COUNTY")})
    quarters = items.groupBy("l_partkey").agg(
        _quantity(_shipped("1999-01-01", "2000-01-01")).alias("value")
    ).select(key.alias("GEOID"), F.lit("P042001").alias("variable"), "value")
    counted = units(~early).select(
        key.alias("GEOID"), F.lit("H001001").alias("variable"), F.col("n").alias("value")
    )
    return plans.cutpoints(
        older, housing, components, newer, quarters, counted,
        size_cuts=[(300, "Large"), (200, "Medium"), (None, "Small")], excluded_state=None,
    )


def _units_2010(spark, sf_dir, total: str, vacant: str):
    """Lines per part in total and of early returns, as a long table of two codes."""
    units = table(spark, sf_dir, "lineitem").groupBy(
        number_key("l_partkey", 5).alias("GEOID")
    ).agg(
        F.count(F.lit(1)).alias(total),
        F.count(F.when(
            (F.col("l_returnflag") == "R") & _shipped(None, "1998-07-01"), 1
        )).alias(vacant),
    )
    return to_long(units, ["GEOID"], [total, vacant])


_MERGED_UNITS = f"""units AS (SELECT CASE g WHEN '00003' THEN '00007' WHEN '00004' THEN '00007'
      ELSE g END AS GEOID, count(*) AS total,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1998-07-01') AS vacant
    FROM (SELECT {_pad('l_partkey')} AS g, * FROM lineitem) WHERE NOT starts_with(g, '72')
    GROUP BY 1),
  merged AS (SELECT GEOID, vacant / nullif(total, 0) * 100 AS pct FROM units),
  vacancy AS (SELECT * FROM merged UNION ALL SELECT v, pct FROM merged,
    (VALUES ('90001'), ('90003')) t(v) WHERE GEOID = '00020')"""


@query(f"""WITH {_MERGED_UNITS} SELECT GEOID, round(pct, 6) AS cen2010_pct_vacant_hu
  FROM vacancy""")
def vacancy_2010(spark, sf_dir):
    return plans.vacancy_2010(
        _units_2010(spark, sf_dir, "H001001", "H001003"), merged=MERGED, split=SPLIT
    )


# --- The main table -----------------------------------------------------------

_METRIC_OF = {v: k for k, v in COUNT_ALIASES.items()}
_COUNTS = ["POP_TOT", *[f"{g}_TOT" for g in GROUPS], "HU_TOT", "GQ_TOT"]


def _main_inputs(spark, sf_dir):
    panel = area_panel(spark, sf_dir)
    key = number_key("area", 5)
    counts = panel.select(
        key.alias("fips"), *[F.col(f"CEN_{c}").alias(_METRIC_OF[f"CEN_{c}"]) for c in _COUNTS],
        F.col("CEN_GQ_TOT").alias("hu_vacant"),
    )
    known = panel.select(
        key.alias("GEOID"), *[f"EST_{c}" for c in _COUNTS], F.lit(2020).alias("GEOYEAR"),
        F.concat(F.lit("State "), F.substring(key, 1, 2)).alias("STNAME"),
        F.when(F.col("area") == 1, "District of Columbia")
        .otherwise(F.concat(F.lit("Area "), key)).alias("CTYNAME"),
        (F.col("EST_HU_TOT") * 2.5).alias("PCT_HH_BROADBAND"),
        F.lit(75.5).alias("PCT_HH_BROADBAND_NATIONAL"),
    )
    bands = calibrate_bands(graded_panel(spark, sf_dir))
    return counts, known, bands, _units_2010(spark, sf_dir, "H003001", "H003003")


_NOTES_SQL = "CASE GEOID " + " ".join(
    f"WHEN '{key}' THEN '{note}'" for key, note in AREA_NOTES.items()
) + " ELSE '' END"


def _main_sql(compat: bool) -> str:
    def over(n, d):
        return f"{n} / nullif({d}, 0)"

    cen_sums = ", ".join(
        f"CASE WHEN count(CEN_{c}) = count(*) THEN CAST(sum(CEN_{c}) AS BIGINT) END AS CEN_{c}"
        for c in _COUNTS
    )
    pairs = {n: (f"CEN_{m}", f"EST_{m}") for n, m in DIFF_METRICS.items()}
    diffs = ", ".join(f"{c} - {e} AS {n}_DIFF" for n, (c, e) in pairs.items())

    def share(name, cen, est):
        zero = f"{cen} - {est} = 0" + (f" OR {cen} = 0" if name in ZERO_IF_ACTUAL_ZERO else "")
        unbounded = (
            f"WHEN {est} = 0 AND {cen} > 0 THEN 'inf'::DOUBLE "
            f"WHEN {est} = 0 AND {cen} < 0 THEN '-inf'::DOUBLE " if compat else ""
        )
        return (
            f"CASE WHEN {zero} THEN 0.0 {unbounded}"
            f"ELSE ({cen} - {est}) / nullif({est}, 0)::DOUBLE END AS SHARE_{name}_DIFF"
        )

    shares = ", ".join(share(n, c, e) for n, (c, e) in pairs.items())

    def label(metric):
        a, e = f"CEN_{metric}", f"EST_{metric}"
        if metric == "PPH_RAT":
            a, e = "CEN_PPH_TOT", "EST_PPH_TOT"
        elif metric.endswith("_PROP"):
            g = metric.removesuffix("_PROP")
            a, e = (f"({over(f'{s}_{g}_TOT', f'{s}_POP_TOT')})" for s in ("CEN", "EST"))
        d = f"{a} - {e}"
        if metric in RELATIVE_METRICS:
            base = f"({a} + {e} / 2)" if compat else e
            d = f"CASE WHEN {a} - {e} = 0 THEN 0 ELSE ({a} - {e}) / nullif({base}, 0) END"
        b = f"{metric}_b"
        return (
            f"(SELECT CASE WHEN d >= {b}.range_2_high OR d <= {b}.range_2_low THEN '{HIGH}' "
            f"WHEN d >= {b}.range_1_high OR d <= {b}.range_1_low THEN '{SLIGHT}' "
            f"WHEN d < {b}.range_1_high AND d > {b}.range_1_low THEN '{CLOSE}' END "
            f"FROM (SELECT {d} AS d)) AS {MEASURE_NAMES[metric]}"
        )

    labels = ", ".join(label(m) for m in MEASURE_NAMES)
    joins = " ".join(
        f"LEFT JOIN bands AS {m}_b ON {m}_b.variable = '{m}' "
        f"AND {m}_b.SIZE_CLASS IS NOT DISTINCT FROM full_table.SIZE_CLASS"
        for m in MEASURE_NAMES
    )
    vacancy = "merged" if compat else "vacancy"
    rounded = [c for c in COUNTY_MAIN_COLUMNS if c.startswith(("SHARE_", "PCT_")) or "PPH" in c]
    out = ", ".join(
        f"round({c}, 6) AS {c}" if c in rounded and not c.endswith("MEASURE") else c
        for c in COUNTY_MAIN_COLUMNS if c not in ("GEOID", "VACANCY_MEASURE", "PCT_VACANT_CHANGE",
                                                  "PCT_VACANT_HU_2010")
    )
    change = "PCT_VACANT_HU_2020 - pct"
    return f"""WITH {SIZED_SQL}, {long_sql(METRICS)}, {_DIFFS}, {_BANDS}, {_MERGED_UNITS},
  cen AS (SELECT {_pad('area')} AS GEOID, {", ".join(f"CEN_{c}" for c in _COUNTS)},
    CEN_GQ_TOT AS CEN_HU_VACANT_TOT FROM panel),
  with_parents AS (SELECT * FROM cen UNION ALL BY NAME SELECT parent AS GEOID, {cen_sums},
      CASE WHEN count(CEN_HU_VACANT_TOT) = count(*)
        THEN CAST(sum(CEN_HU_VACANT_TOT) AS BIGINT) END AS CEN_HU_VACANT_TOT
    FROM cen JOIN {_ROLLED_SQL} ON member = GEOID GROUP BY parent),
  known AS (SELECT {_pad('area')} AS GEOID, {", ".join(f"EST_{c}" for c in _COUNTS)},
    2020 AS GEOYEAR, 'State ' || substring({_pad('area')}, 1, 2) AS STNAME,
    CASE WHEN area = 1 THEN 'Washington' ELSE 'Area ' || {_pad('area')} END AS CTYNAME,
    EST_HU_TOT * 2.5::DOUBLE AS PCT_HH_BROADBAND, 75.5::DOUBLE AS PCT_HH_BROADBAND_NATIONAL
    FROM panel),
  base AS (SELECT *, CEN_POP_TOT - CEN_GQ_TOT AS CEN_HH_TOT,
    EST_POP_TOT - EST_GQ_TOT AS EST_HH_TOT,
    (CEN_POP_TOT - CEN_GQ_TOT) / nullif(CEN_HU_TOT, 0) AS CEN_PPH_TOT,
    (EST_POP_TOT - EST_GQ_TOT) / nullif(EST_HU_TOT, 0) AS EST_PPH_TOT,
    CEN_HU_VACANT_TOT / nullif(CEN_HU_TOT, 0) * 100 AS PCT_VACANT_HU_2020,
    {_NOTES_SQL} AS NOTES,
    CASE WHEN CEN_POP_TOT >= 450 THEN 'Large' WHEN CEN_POP_TOT >= 350 THEN 'Medium'
      WHEN CEN_POP_TOT IS NOT NULL THEN 'Small' END AS SIZE_CLASS
    FROM with_parents LEFT JOIN known USING (GEOID)),
  full_table AS (SELECT *, {diffs}, {shares} FROM base),
  graded AS (SELECT full_table.*, {labels} FROM full_table {joins})
  SELECT coalesce(graded.GEOID, {vacancy}.GEOID) AS GEOID, {out},
    round(pct, 6) AS PCT_VACANT_HU_2010, round({change}, 6) AS PCT_VACANT_CHANGE,
    CASE WHEN abs({change}) >= 5 THEN '{HIGH}' WHEN abs({change}) >= 2.5 THEN '{SLIGHT}'
      WHEN abs({change}) < 2.5 THEN '{CLOSE}' END AS VACANCY_MEASURE
  FROM graded FULL JOIN {vacancy} ON graded.GEOID = {vacancy}.GEOID"""


@query(_main_sql(compat=False))
def county_main(spark, sf_dir):
    return plans.county_main(
        *_main_inputs(spark, sf_dir), rolled_up=ROLLED_UP, merged=MERGED, split=SPLIT,
        size_cuts=SIZES,
    )


@query(_main_sql(compat=True))
def county_main_compat(spark, sf_dir):
    """The scripted behaviour, quirk by quirk."""
    return plans.county_main(
        *_main_inputs(spark, sf_dir), compat=True, rolled_up=ROLLED_UP, merged=MERGED,
        split=SPLIT, size_cuts=SIZES,
    )


# --- Context tables -----------------------------------------------------------

_Y1997 = (dt.date(1997, 1, 1), dt.date(1998, 1, 1))


def _covid_sql(national: str) -> str:
    return f"""WITH sundays AS (SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey, l_quantity
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-02'
      AND l_shipdate < TIMESTAMP '1998-01-01' AND dayofweek(l_shipdate) = 0),
  us AS (SELECT date, avg(l_quantity) AS us FROM sundays GROUP BY 1),
  own AS (SELECT date, l_suppkey, avg(l_quantity) AS own FROM sundays GROUP BY 1, 2),
  grid AS (SELECT {_pad('s_suppkey')} AS geoid, us.date, us, own FROM supplier CROSS JOIN us
    LEFT JOIN own ON own.l_suppkey = s_suppkey AND own.date = us.date),
  rolled AS (SELECT parent, date, {national} AS us,
    CASE WHEN count(own) = count(*) THEN sum(own) END AS own
    FROM grid JOIN {_ROLLED_SQL} ON member = geoid GROUP BY 1, 2)
  SELECT geoid, CAST(date AS VARCHAR) AS date, round(us, 6) AS national_cases_avg_per_100k,
    round(own, 6) AS county_cases_avg_per_100k
  FROM (SELECT * FROM grid UNION ALL SELECT * FROM rolled)"""


def _covid(spark, sf_dir, compat):
    items = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), "l_suppkey", "l_quantity"
    )
    rate = F.avg("l_quantity").alias("cases_avg_per_100k")
    local = items.groupBy("date", "l_suppkey").agg(rate).select(
        "date", F.concat(F.lit("USA-"), number_key("l_suppkey", 5)).alias("geoid"),
        "cases_avg_per_100k",
    )
    areas = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("fips")
    )
    return plans.covid_weekly(
        areas, items.groupBy("date").agg(rate), local, *_Y1997, rolled_up=ROLLED_UP,
        compat=compat,
    )


@query(_covid_sql("max(us)"))
def covid_weekly(spark, sf_dir):
    return _covid(spark, sf_dir, compat=False)


@query(_covid_sql("sum(us)"))
def covid_weekly_compat(spark, sf_dir):
    """The national rate is added up for the rolled-up area as well."""
    return _covid(spark, sf_dir, compat=True)


_RATE_SQL = "CASE WHEN {q} % 10 = 0 THEN NULL ELSE CAST({q} AS DOUBLE) END"


@query(f"""WITH r AS (SELECT {_pad('l_suppkey')} AS GEOID, year(l_shipdate) AS y,
    CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem
    WHERE year(l_shipdate) IN (1997, 1998) GROUP BY ALL),
  us AS (SELECT y, CAST(sum(q) AS DOUBLE) AS us FROM r GROUP BY y),
  rr AS (SELECT GEOID, CAST(CASE y WHEN 1997 THEN 2010 ELSE 2020 END AS INTEGER) AS year,
    {_RATE_SQL.format(q='q')} AS rate, us FROM r JOIN us USING (y))
  SELECT GEOID, year, rate AS "county-response-rate", us AS "us-response-rate" FROM rr
  UNION ALL SELECT parent, year, CASE WHEN count(rate) = count(*) THEN round(avg(rate), 6) END,
    round(avg(us), 6) FROM rr JOIN {_ROLLED_SQL} ON member = GEOID GROUP BY parent, year""")
def response_rates(spark, sf_dir):
    key = number_key("l_suppkey", 5)
    sums = table(spark, sf_dir, "lineitem").filter(_shipped("1997-01-01", "1999-01-01")).groupBy(
        "l_suppkey", F.year("l_shipdate").alias("y")
    ).agg(F.sum("l_quantity").cast("bigint").alias("q"))
    year = F.when(F.col("y") == 1997, 2010).otherwise(2020).alias("year")
    county = sums.select(
        F.substring(key, 1, 2).alias("state"), F.substr(key, F.lit(3)).alias("county"), year,
        F.when(F.col("q") % 10 == 0, "n/a").otherwise(F.col("q").cast("string")).alias("rate"),
    )
    national = sums.groupBy("y").agg(F.sum("q").cast("string").alias("rate")).select(year, "rate")
    return plans.response_rates(county, national, rolled_up=ROLLED_UP)


def _unemployment_sql(width: int) -> str:
    return f"""WITH series AS (SELECT 'LAUCN' || {_pad('l_suppkey')} || '00000000'
      || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS series_id, month(l_shipdate) AS m,
    sum(l_quantity) AS v FROM lineitem WHERE year(l_shipdate) = 1997
      AND NOT (month(l_shipdate) = 12 AND l_returnflag = 'A') GROUP BY ALL),
  us AS (SELECT month(l_shipdate) AS m, sum(l_quantity) AS us FROM lineitem
    WHERE year(l_shipdate) = 1997 GROUP BY 1)
  SELECT substring(series_id, 6, {width}) AS GEOID,
    lpad(CAST(m AS VARCHAR), 2, '0') || '/01/97' AS month, v AS county_unemployment_rate,
    us AS national_unemployment_rate FROM series LEFT JOIN us USING (m)
  WHERE regexp_matches(series_id, 'LAUCN.+03$')"""


def _unemployment(spark, sf_dir, compat):
    month = F.month("l_shipdate")
    national = table(spark, sf_dir, "lineitem").filter(
        _shipped("1997-01-01", "1998-01-01")
    ).groupBy(month.alias("m")).agg(
        F.sum("l_quantity").alias("national_unemployment_rate")
    ).select(
        F.concat(number_key("m", 2), F.lit("/01/97")).alias("month"),
        "national_unemployment_rate",
    )
    series = labour_series(spark, sf_dir, 1997)
    return plans.unemployment(series, national, year=1997, compat=compat)


@query(_unemployment_sql(5))
def unemployment(spark, sf_dir):
    return _unemployment(spark, sf_dir, compat=False)


@query(_unemployment_sql(6))
def unemployment_compat(spark, sf_dir):
    """Six characters of the series id as area code."""
    return _unemployment(spark, sf_dir, compat=True)


@query("""SELECT n_name AS STNAME, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS State,
    s_name AS CTYNAME, lpad(CAST(s_suppkey AS VARCHAR), 3, '0') AS County,
    lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || lpad(CAST(s_suppkey AS VARCHAR), 3, '0')
      AS GEOID, 'Severe Storms, Straight-Line Winds And ' || upper(substring(n_name, 1, 1))
      || lower(substring(n_name, 2)) || '-' || s_suppkey AS declarationTitle,
    'https://example.org/' || s_suppkey AS FEMAWEB, 'DR-' || s_suppkey AS fema_id,
    '2020-01-01' AS IB_date, CAST(NULL AS VARCHAR) AS IE_date
  FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def disasters(spark, sf_dir):
    supplier, nation = (table(spark, sf_dir, t) for t in ("supplier", "nation"))
    state, county = number_key("s_nationkey", 2), number_key("s_suppkey", 3)
    number = F.col("s_suppkey").cast("string")
    return plans.disasters(
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.col("n_name").alias("STNAME"), state.alias("State"),
            F.col("s_name").alias("CTYNAME"), county.alias("County"),
            F.concat(state, county).alias("GEOID"),
            F.concat(
                F.lit("SEVERE STORMS, STRAIGHT-LINE WINDS AND "), "n_name", F.lit("-"), number
            ).alias("declarationTitle"),
            F.concat(F.lit("https://example.org/"), number).alias("FEMAWEB"),
            F.concat(F.lit("DR-"), number).alias("fema_id"),
            F.lit("2020-01-01").alias("IB_date"), F.lit(None).cast("string").alias("IE_date"),
            F.lit("not kept").alias("other"),
        )
    )
