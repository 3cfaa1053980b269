"""Selection, projection, aggregates, reshaping and row binds."""

from __future__ import annotations

from pyspark.sql import functions as F

from geopanel.catalog.inputs import table
from geopanel.catalog.registry import query
from geopanel.constants import CLOSE, HIGH
from geopanel.functions import (
    cases,
    finite_or,
    half_even,
    if_else,
    is_member,
    numeric_columns,
    ratio,
    strict_mean,
    strict_sd,
    strict_sum,
    sum_columns,
)
from geopanel.operators import columns as L
from geopanel.operators.crosswalk import roll_up_rows
from geopanel.operators.enrich import outside_state
from geopanel.operators.reshape import to_long, to_wide
from geopanel.sources.coded import select_codes


@query("""SELECT l_orderkey, l_linenumber, l_partkey AS part,
    CAST(l_quantity AS BIGINT) AS qty, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped,
    2020 AS vintage FROM lineitem
  WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R') AND l_linenumber <> 7
    AND NOT starts_with(CAST(l_partkey AS VARCHAR), '72')
    AND l_shipdate >= TIMESTAMP '1997-01-02' AND l_shipdate < TIMESTAMP '1998-01-01'""")
def record_select(spark, sf_dir):
    """Equality, list, inequality, prefix and range filters; rename and constant."""
    items = table(spark, sf_dir, "lineitem")
    kept = items.filter(
        (F.col("l_linestatus") == "F") & F.col("l_returnflag").isin("A", "R")
        & (F.col("l_linenumber") != 7)
        & (F.col("l_shipdate") >= F.lit("1997-01-02").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    ).withColumn("key", F.col("l_partkey").cast("string")).filter(outside_state("key"))
    return kept.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"),
        F.col("l_quantity").cast("bigint").alias("qty"), F.to_date("l_shipdate").alias("shipped"),
        F.lit(2020).alias("vintage"),
    )


@query("""SELECT o_orderkey, flag FROM (SELECT o_orderkey,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS flag FROM orders)
  WHERE flag IS NULL OR flag NOT IN ('F')""")
def not_in_keeps_null(spark, sf_dir):
    """Exclusion by list keeps the rows without a value."""
    flagged = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("flag")
    )
    return flagged.filter(~is_member("flag", ["F"]))


@query("""SELECT p_partkey, p_size, p_size * 2 AS twice, p_size * 2 + 1 AS odd,
    p_retailprice AS price, p_brand, p_type FROM part""")
def relocate_and_derive(spark, sf_dir):
    """Columns derived in sequence, dropped, renamed and moved to the front."""
    part = table(spark, sf_dir, "part").drop("p_name")
    derived = part.withColumn("twice", F.col("p_size") * 2).withColumn("odd", F.col("twice") + 1)
    renamed = derived.withColumnsRenamed({"p_retailprice": "price"})
    return L.relocate(renamed, "p_partkey", L.containing(renamed, "SIZE"), "twice", "odd")


@query("""SELECT user_id, event_type, count(*) AS n,
    CASE WHEN count(v) = count(*) THEN round(sum(v), 4) END AS total,
    CASE WHEN count(v) = count(*) THEN round(avg(v), 6) END AS mean,
    CASE WHEN count(v) = count(*) THEN round(stddev_samp(v), 6) END AS sd
  FROM (SELECT user_id, event_type, CASE WHEN value >= 5 THEN value END AS v FROM events)
  GROUP BY ALL""")
def strict_aggregates(spark, sf_dir):
    """One missing value makes the group's figure missing."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.when(F.col("value") >= 5, F.col("value")).alias("v")
    )
    return events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(strict_sum("v"), 4).alias("total"),
        strict_mean("v").alias("mean"), strict_sd("v").alias("sd"),
    )


_MONEY = ["l_extendedprice", "l_discount", "l_tax"]


@query("SELECT CAST(sum(l_quantity) AS DOUBLE) AS l_quantity, " + ", ".join(
    f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) AS {c}" for c in _MONEY
) + ", CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber FROM lineitem")
def sum_all_numeric(spark, sf_dir):
    """Sum of every numeric column over the whole table."""
    items = table(spark, sf_dir, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey")
    exact = items.withColumns({c: F.col(c).cast("decimal(18,2)") for c in _MONEY})
    summed = exact.agg(*[strict_sum(c).alias(c) for c in numeric_columns(exact)])
    return summed.withColumns({c: F.col(c).cast("double") for c in _MONEY})


@query("""SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS l_quantity,
    round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax
  FROM lineitem GROUP BY ALL""")
def mean_all_numeric(spark, sf_dir):
    """Mean of every numeric column per group."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"
    )
    return items.groupBy("l_returnflag", "l_linestatus").agg(
        *[strict_mean(c).alias(c) for c in numeric_columns(items)]
    )


@query("""SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS n
  FROM lineitem GROUP BY l_suppkey""")
def distinct_group_sum(spark, sf_dir):
    """The group sum once per group."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    return items.groupBy("l_suppkey").agg(
        strict_sum("l_quantity").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("n")
    )


@query("""SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority"
    ).dropDuplicates()


@query("""SELECT '99999' AS area, count(*) AS n, min_by(c_name, c_custkey) AS c_name,
    CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer
  WHERE c_nationkey IN (1, 2)""")
def rollup_first_row(spark, sf_dir):
    """Figures of the member areas added up, text taken from the first member."""
    customer = table(spark, sf_dir, "customer")
    areas = customer.select(
        F.col("c_nationkey").cast("string").alias("area"), "c_custkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), F.lit(1).alias("n"),
    )
    rolled = roll_up_rows(
        areas, "area", {"99999": ["1", "2"]}, columns=["balance", "n"],
        extra=[F.min("c_custkey").alias("c_custkey")],
    )
    named = rolled.join(customer.select("c_custkey", "c_name"), "c_custkey")
    return named.withColumn("balance", F.col("balance").cast("double")).drop("c_custkey")


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(
    f"round(max(v) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in _TYPES
) + """ FROM (SELECT user_id, event_type, avg(value) AS v FROM events GROUP BY ALL)
  GROUP BY user_id""")
def pivot_codes(spark, sf_dir):
    """Long to wide, one column per event type."""
    long = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.avg("value").alias("v")
    )
    return to_wide(long, ["user_id"], "event_type", "v", _TYPES)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, v.variable, v.value FROM
  (SELECT l_orderkey, l_linenumber, l_partkey, unnest([
    {'variable': 'l_quantity', 'value': l_quantity},
    {'variable': 'l_discount', 'value': l_discount},
    {'variable': 'l_tax', 'value': l_tax}]) AS v FROM lineitem)""")
def unpivot_columns(spark, sf_dir):
    """Wide to long over three columns."""
    return to_long(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"],
        ["l_quantity", "l_discount", "l_tax"],
    )


@query("""SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier
  UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer""")
def bind_strict(spark, sf_dir):
    """Row bind by name; the second frame has its columns in another order."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
    )
    return L.bind_rows(supplier, customer)


@query("""SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier
  UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer""")
def bind_fill(spark, sf_dir):
    """Row bind with columns missing on either side."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")
    )
    return L.bind_rows(supplier, customer, fill=True)


@query("""SELECT variable, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM (
    SELECT CASE line WHEN 1 THEN 'first' WHEN 3 THEN 'third' END AS variable,
      l_quantity AS v FROM (SELECT l_linenumber AS line, l_quantity FROM lineitem)
    WHERE line IN (1, 3)) GROUP BY variable""")
def coded_long_scan(spark, sf_dir):
    """Listed codes of a long table under their names."""
    long = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("variable"),
        F.col("l_quantity").alias("value"),
    )
    named = select_codes(long, {"L1": "first", "L3": "third"})
    return named.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("total")
    )


@query(f"""SELECT event_id, CASE WHEN v IS NULL THEN NULL WHEN v >= 50 THEN '{HIGH}'
      ELSE '{CLOSE}' END AS two_way,
    CASE WHEN v >= 100 THEN 'A' WHEN v >= 20 THEN 'B' WHEN v < 20 THEN 'C' END AS many_way,
    coalesce(v > 30 AND event_type IN ('click', 'view'), false) AS member,
    round(coalesce(v / nullif(user_id % 7, 0), 0), 6) AS finite
  FROM (SELECT *, CASE WHEN value >= 5 THEN value END AS v FROM events)""")
def conditional_nulls(spark, sf_dir):
    """How the conditionals treat a missing condition."""
    v = F.when(F.col("value") >= 5, F.col("value"))
    return table(spark, sf_dir, "events").withColumn("v", v).select(
        "event_id", if_else(F.col("v") >= 50, F.lit(HIGH), F.lit(CLOSE)).alias("two_way"),
        cases([(F.col("v") >= 100, "A"), (F.col("v") >= 20, "B"), (F.col("v") < 20, "C")])
        .alias("many_way"),
        F.coalesce((F.col("v") > 30) & is_member("event_type", ["click", "view"]), F.lit(False))
        .alias("member"),
        finite_or(ratio("v", F.col("user_id") % 7), 0).alias("finite"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(l_quantity / 2, 0) AS BIGINT)
    AS half, CAST(abs(l_quantity - 25) AS BIGINT) AS distance,
    l_quantity + l_linenumber + l_partkey AS total FROM lineitem""")
def half_even_rounding(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        half_even(F.col("l_quantity") / 2).cast("bigint").alias("half"),
        F.abs(F.col("l_quantity") - 25).cast("bigint").alias("distance"),
        sum_columns(["l_quantity", "l_linenumber", "l_partkey"]).alias("total"),
    )
