"""Figures derived from two sources or two dates, and coded categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from geopanel.catalog.inputs import PANEL_SQL, SIZED_SQL, SIZES, area_panel, table
from geopanel.catalog.registry import query
from geopanel.constants import (
    CLOSE,
    DIFF_METRICS,
    HIGH,
    REALLOCATION_FACTORS,
    SLIGHT,
    ZERO_IF_ACTUAL_ZERO,
)
from geopanel.operators import categories as C
from geopanel.operators import compare as P

_TOTALS = {n: m for n, m in DIFF_METRICS.items() if n != "PPH"}


def _share_sql(name: str, metric: str) -> str:
    settled = f"CEN_{metric} - EST_{metric} = 0"
    if name in ZERO_IF_ACTUAL_ZERO:
        settled += f" OR CEN_{metric} = 0"
    return (
        f"CEN_{metric} - EST_{metric} AS {name}_DIFF, round(CASE WHEN {settled} THEN 0.0 "
        f"ELSE (CEN_{metric} - EST_{metric}) / nullif(EST_{metric}, 0)::DOUBLE END, 6) "
        f"AS SHARE_{name}_DIFF"
    )


@query(
    f"WITH {PANEL_SQL} SELECT area, "
    + ", ".join(_share_sql(n, m) for n, m in _TOTALS.items()) + " FROM panel"
)
def compare_sources(spark, sf_dir):
    """Raw and share difference of every count."""
    compared = P.compare_sources(area_panel(spark, sf_dir), _TOTALS, ZERO_IF_ACTUAL_ZERO)
    return compared.select(
        "area", *[c for n in _TOTALS for c in (f"{n}_DIFF", f"SHARE_{n}_DIFF")]
    )


@query("""WITH base AS (SELECT l_suppkey,
    sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a,
    sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS n,
    sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS r,
    sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey)
  SELECT l_suppkey, round(a / nullif(total, 0), 6) AS share_a,
    round(n / nullif(total, 0), 6) AS share_n, round(r / nullif(total, 0), 6) AS share_r
  FROM base""")
def composition_shares(spark, sf_dir):
    quantity = {
        f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))) for f in "ANR"
    }
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        *[c.alias(f"qty_{f.lower()}") for f, c in quantity.items()],
        F.sum("l_quantity").alias("total"),
    )
    shares = P.proportions(grouped, {f"share_{f}": f"qty_{f}" for f in "anr"}, "total")
    return shares.select("l_suppkey", "share_a", "share_n", "share_r")


@query(f"""WITH {PANEL_SQL} SELECT area, EST_POP_TOT - EST_GQ_TOT AS EST_HH_TOT,
    CEN_POP_TOT - CEN_GQ_TOT AS CEN_HH_TOT,
    round((EST_POP_TOT - EST_GQ_TOT) / nullif(EST_HU_TOT, 0), 6) AS EST_PPH_TOT,
    round((CEN_POP_TOT - CEN_GQ_TOT) / nullif(CEN_HU_TOT, 0), 6) AS CEN_PPH_TOT FROM panel""")
def household_ratio(spark, sf_dir):
    panel = area_panel(spark, sf_dir)
    return panel.select("area", *[
        c for s in ("EST", "CEN") for c in (
            P.household(f"{s}_POP_TOT", f"{s}_GQ_TOT").alias(f"{s}_HH_TOT"),
            P.per_unit(f"{s}_POP_TOT", f"{s}_GQ_TOT", f"{s}_HU_TOT").alias(f"{s}_PPH_TOT"),
        )
    ])


@query(f"""WITH {SIZED_SQL} SELECT SIZE_CLASS, count(*) AS areas,
    CAST(sum(CEN_POP_TOT) AS BIGINT) AS population FROM sized GROUP BY SIZE_CLASS""")
def size_classes(spark, sf_dir):
    panel = area_panel(spark, sf_dir).select("CEN_POP_TOT")
    return panel.groupBy(P.size_class("CEN_POP_TOT", SIZES).alias("SIZE_CLASS")).agg(
        F.count(F.lit(1)).alias("areas"), F.sum("CEN_POP_TOT").alias("population")
    )


# Share of finished orders per customer, before and after mid 1998.
@query(f"""WITH rates AS (SELECT o_custkey,
    count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-07-01' AND o_orderstatus = 'F')
      / nullif(count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-07-01'), 0) * 100 AS pct_then,
    count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-07-01' AND o_orderstatus = 'F')
      / nullif(count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-07-01'), 0) * 100 AS pct_now
    FROM orders GROUP BY o_custkey)
  SELECT o_custkey, round(pct_now, 6) AS pct_now, round(pct_then, 6) AS pct_then,
    round(pct_now - pct_then, 6) AS change,
    CASE WHEN abs(pct_now - pct_then) >= 25 THEN '{HIGH}'
         WHEN abs(pct_now - pct_then) >= 10 THEN '{SLIGHT}'
         WHEN abs(pct_now - pct_then) < 10 THEN '{CLOSE}' END AS measure FROM rates""")
def change_grade(spark, sf_dir):
    early = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    done = F.col("o_orderstatus") == "F"
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.when(early & done, 1)).alias("done_then"),
        F.count(F.when(early, 1)).alias("all_then"),
        F.count(F.when(~early & done, 1)).alias("done_now"),
        F.count(F.when(~early, 1)).alias("all_now"),
    )
    rates = counts.select(
        "o_custkey", P.percent("done_now", "all_now").alias("pct_now"),
        P.percent("done_then", "all_then").alias("pct_then"),
    )
    return P.grade_change(rates, "pct_now", "pct_then", (25.0, 10.0))


@query("""WITH years AS (SELECT o_custkey,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE year(o_orderdate) = 1997) AS y97,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE year(o_orderdate) = 1998) AS y98
    FROM orders GROUP BY o_custkey)
  SELECT o_custkey, CAST(round_even(CAST(y97 AS DOUBLE)
    + (CAST(y98 AS DOUBLE) - CAST(y97 AS DOUBLE)) / 12 * 9, 0) AS BIGINT) AS april_1998
  FROM years""")
def interpolate_annual(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    year = F.year("o_orderdate")
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(*[
        F.sum(F.when(year == y, price)).cast("double").alias(f"y{y}") for y in (1997, 1998)
    ])
    return totals.select("o_custkey", P.interpolate("y1997", "y1998").alias("april_1998"))


_F = REALLOCATION_FACTORS


@query(f"""WITH base AS (SELECT l_suppkey, CAST(sum(l_quantity) FILTER (WHERE l_linenumber = 7)
      AS BIGINT) AS other,
    {", ".join(f"CAST(coalesce(sum(l_quantity) FILTER (WHERE l_linenumber = {i}), 0) AS BIGINT) AS {g}_base" for i, g in enumerate(_F, 1))}
    FROM lineitem GROUP BY l_suppkey),
  parts AS (SELECT *, {", ".join(f"CAST(round_even(other * {f}::DOUBLE, 0) AS BIGINT) AS {g}_part" for g, f in _F.items())}
    FROM base)
  SELECT l_suppkey, other,
    white_base + white_part
      - (white_part + black_part + aian_part + asian_part + nhpi_part + multi_part - other)
      AS white,
    {", ".join(f"{g}_base + {g}_part AS {g}" for g in _F if g != "white")} FROM parts""")
def reallocate_residual(spark, sf_dir):
    """Quantity of line 7 spread over lines 1 to 6, totals preserved."""
    quantity = F.col("l_quantity")
    base = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_linenumber") == 7, quantity)).cast("bigint").alias("other"),
        *[
            F.coalesce(F.sum(F.when(F.col("l_linenumber") == i, quantity)), F.lit(0))
            .cast("bigint").alias(f"{g}_base")
            for i, g in enumerate(_F, 1)
        ],
    )
    spread = C.reallocate(
        base, "other", _F, {g: f"{g}_base" for g in _F}, "white", {g: g for g in _F}
    )
    return spread.select("l_suppkey", "other", *_F)


_TYPES = {
    "plain": ["STANDARD", "ECONOMY"],
    "sized": ["SMALL", "MEDIUM", "LARGE"],
    "promoted": ["PROMO"],
}


@query("""WITH long AS (SELECT p_brand, p_type, CAST(sum(p_size) AS BIGINT) AS v
    FROM part GROUP BY p_brand, p_type)
  SELECT p_brand,
    CASE WHEN count(v) FILTER (WHERE p_type IN ('STANDARD', 'ECONOMY')) = 2
      THEN CAST(sum(v) FILTER (WHERE p_type IN ('STANDARD', 'ECONOMY')) AS BIGINT) END AS plain,
    CASE WHEN count(v) FILTER (WHERE p_type IN ('SMALL', 'MEDIUM', 'LARGE')) = 3
      THEN CAST(sum(v) FILTER (WHERE p_type IN ('SMALL', 'MEDIUM', 'LARGE')) AS BIGINT) END
      AS sized,
    CAST(max(v) FILTER (WHERE p_type = 'PROMO') AS BIGINT) AS promoted
  FROM long GROUP BY p_brand""")
def collapse_categories(spark, sf_dir):
    long = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(
        F.sum("p_size").alias("v")
    )
    return C.collapse_categories(long, ["p_brand"], "p_type", "v", _TYPES)


@query("""WITH coded AS (SELECT l_quantity, 'P' || CASE l_linestatus WHEN 'F' THEN '2' ELSE '4' END
      || '_0' || lpad(CAST(l_orderkey % 73 + 1 AS VARCHAR), 2, '0') || 'N' AS code FROM lineitem)
  SELECT substring(code, 2, 1) AS tab, substring(code, 5, 2) AS item,
    CASE substring(code, 2, 1) WHEN '2' THEN 'total' ELSE 'over17' END AS age,
    count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty FROM coded GROUP BY ALL""")
def decode_codes(spark, sf_dir):
    """Codes built from the order key, added up per code, then decoded."""
    number = F.lpad((F.col("l_orderkey") % 73 + 1).cast("string"), 2, "0")
    digit = F.when(F.col("l_linestatus") == "F", "2").otherwise("4")
    coded = table(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("P"), digit, F.lit("_0"), number, F.lit("N")).alias("code")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"))
    fields = C.decode_code("code")
    return coded.select(
        fields["table"].alias("tab"), fields["item"].alias("item"), fields["age"].alias("age"),
        "n", "qty",
    )


@query("""WITH codes AS (SELECT 'P2_0' || lpad(CAST(i AS VARCHAR), 2, '0') || 'N' AS code, i
    FROM range(1, 74) t(i))
  SELECT code, count(l_orderkey) AS n FROM codes
  LEFT JOIN lineitem ON l_orderkey % 73 + 1 = i GROUP BY code""")
def code_list(spark, sf_dir):
    """The generated code list with the number of line items of each code."""
    used = table(spark, sf_dir, "lineitem").groupBy(
        (F.col("l_orderkey") % 73 + 1).cast("int").alias("item")
    ).agg(F.count(F.lit(1)).alias("n"))
    codes = C.code_rows(spark, "P2_", "N")
    return codes.join(used, "item", "left").select(
        "code", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


