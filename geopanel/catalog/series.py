"""Time series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from geopanel.catalog.inputs import labour_series, table
from geopanel.catalog.registry import query
from geopanel.operators import series as S
from geopanel.operators.joins import attach_context

_JAN = (dt.date(2024, 1, 1), dt.date(2024, 1, 29))
_Y1997 = (dt.date(1997, 1, 1), dt.date(1998, 1, 1))


@query("""SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, value FROM events
  WHERE CAST(ts AS DATE) > DATE '2024-01-01' AND CAST(ts AS DATE) < DATE '2024-01-29'
    AND dayofweek(ts) = 0""")
def weekly_sample(spark, sf_dir):
    sampled = S.weekly_sample(table(spark, sf_dir, "events"), "ts", *_JAN)
    return sampled.select("event_id", F.to_date("ts").alias("day"), "user_id", "value")


@query("""WITH days AS (SELECT CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS overall
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-02'
      AND l_shipdate < TIMESTAMP '1998-01-01' AND dayofweek(l_shipdate) = 0 GROUP BY 1),
  facts AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS own
    FROM lineitem GROUP BY 1, 2)
  SELECT s_suppkey, CAST(days.day AS VARCHAR) AS day, round(overall, 6) AS overall,
    round(own, 6) AS own FROM supplier CROSS JOIN days
  LEFT JOIN facts ON facts.l_suppkey = s_suppkey AND facts.day = days.day""")
def densify_grid(spark, sf_dir):
    """Every Sunday of 1997 for every supplier; days without shipments as NULL."""
    sampled = S.weekly_sample(table(spark, sf_dir, "lineitem"), "l_shipdate", *_Y1997).select(
        F.col("l_suppkey").alias("s_suppkey"), F.to_date("l_shipdate").alias("day"), "l_quantity"
    )
    calendar = sampled.groupBy("day").agg(F.avg("l_quantity").alias("overall"))
    facts = sampled.groupBy("s_suppkey", "day").agg(F.avg("l_quantity").alias("own"))
    areas = table(spark, sf_dir, "supplier").select("s_suppkey")
    return S.densify(areas, calendar, facts, "s_suppkey", "day", S.week_range(*_Y1997))


@query("""WITH s AS (SELECT nullif(l_suppkey, 1) AS area, CAST(l_shipdate AS DATE) AS day,
    l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-02'
      AND l_shipdate < TIMESTAMP '1998-01-01' AND dayofweek(l_shipdate) = 0),
  days AS (SELECT day, count(*) AS overall FROM s GROUP BY 1),
  facts AS (SELECT area, day, count(*) AS own FROM s GROUP BY 1, 2),
  areas AS (SELECT nullif(s_suppkey, 1) AS area FROM supplier)
  SELECT areas.area, CAST(days.day AS VARCHAR) AS day, overall, own FROM areas CROSS JOIN days
  LEFT JOIN facts ON facts.area IS NOT DISTINCT FROM areas.area AND facts.day = days.day""")
def densify_null_area(spark, sf_dir):
    """An area without code gets the facts without code."""
    sampled = S.weekly_sample(table(spark, sf_dir, "lineitem"), "l_shipdate", *_Y1997).select(
        F.nullif("l_suppkey", F.lit(1)).alias("area"), F.to_date("l_shipdate").alias("day")
    )
    count = F.count(F.lit(1))
    areas = table(spark, sf_dir, "supplier").select(
        F.nullif("s_suppkey", F.lit(1)).alias("area"))
    return S.densify(
        areas, sampled.groupBy("day").agg(count.alias("overall")),
        sampled.groupBy("area", "day").agg(count.alias("own")), "area", "day",
        S.week_range(*_Y1997),
    )


@query("""WITH t AS (SELECT user_id, avg(value) FILTER (WHERE event_type = 'view') AS a,
    avg(value) FILTER (WHERE event_type = 'click') AS b FROM events GROUP BY user_id)
  SELECT user_id, round(a / nullif(b, 0) * 100, 6) AS pct FROM t""")
def percent_of_base(spark, sf_dir):
    long = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.avg("value").alias("v")
    )
    return S.percent_of_base(long, ["user_id"], "event_type", "v", "view", "click", "pct")


_SERIES = """series AS (SELECT 'LAUCN' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') || '00000000'
    || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS series_id, year(l_shipdate) AS year,
    CASE WHEN l_returnflag = 'A' AND month(l_shipdate) = 12 THEN 'M13'
      ELSE 'M' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') END AS period,
    CAST(sum(l_quantity) AS BIGINT) AS value FROM lineitem GROUP BY ALL)"""


@query(f"""WITH {_SERIES} SELECT substring(series_id, 6, 5) AS GEOID,
    substring(period, 2, 2) || '/01/97' AS month, value AS qty FROM series
  WHERE year = 1997 AND period <> 'M13' AND regexp_matches(series_id, 'LAUCN.+03$')""")
def series_decode(spark, sf_dir):
    """Series ids built from supplier and line number, selected and taken apart."""
    decoded = S.decode_series(labour_series(spark, sf_dir, 1997), 1997, out="qty")
    return decoded.withColumn("qty", F.col("qty").cast("bigint"))


@query("""WITH v AS (SELECT o_custkey, year(o_orderdate) AS year, count(*) AS n FROM orders
    WHERE year(o_orderdate) IN (1997, 1998) GROUP BY ALL),
  us AS (SELECT year(o_orderdate) AS year, count(*) AS n_all FROM orders
    WHERE year(o_orderdate) IN (1997, 1998, 1999) GROUP BY ALL)
  SELECT o_custkey, CAST(year AS INTEGER) AS year, n, n_all FROM v FULL JOIN us USING (year)""")
def two_vintage_panel(spark, sf_dir):
    """Two years stacked, joined in full with the overall figures of three."""
    day, year = F.col("o_orderdate"), F.year("o_orderdate").alias("year")
    counts = table(spark, sf_dir, "orders").filter(
        (day >= F.lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz"))
        & (day < F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz"))
    ).groupBy("o_custkey", year).agg(F.count(F.lit(1)).alias("n"))
    # A condition on the count as well, so that both sides share the aggregation.
    local = counts.filter((F.col("n") > 0) & (F.when(F.col("year") < 1999, F.col("n")) > 0))
    overall = counts.groupBy("year").agg(F.sum("n").alias("n_all"))
    return attach_context(local, overall, "year", keep_unmatched=True)


