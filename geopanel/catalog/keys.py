"""Area-code changes and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from geopanel.catalog.inputs import table
from geopanel.catalog.registry import query
from geopanel.functions import number_key
from geopanel.operators import crosswalk as K
from geopanel.operators import joins as J
from geopanel.operators.enrich import area_names, notes, repair_names

# Changes of nation codes, in the three shapes area codes change.
MERGED = {"03": "07", "11": "12", "24": "00"}
SPLIT = {"05": ["91", "92"]}
PARENTS = {"99": ["01", "02"], "98": ["02", "04", "06"]}


def _by_nation(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .groupBy(number_key("c_nationkey", 2).alias("area"), "c_mktsegment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        )
    )


_NATIONS = """nations AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS area,
    c_mktsegment, count(*) AS n,
    CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer GROUP BY ALL)"""


@query(f"""WITH {_NATIONS} SELECT CASE area WHEN '03' THEN '07' WHEN '11' THEN '12'
    WHEN '24' THEN '00' ELSE area END AS area, CAST(sum(n) AS BIGINT) AS n,
    round(sum(balance), 4) AS balance FROM nations GROUP BY 1""")
def crosswalk_merge(spark, sf_dir):
    merged = K.merge_keys(_by_nation(spark, sf_dir), "area", MERGED, ["n", "balance"])
    return merged.withColumn("balance", F.round("balance", 4))


@query("""SELECT 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS area,
    CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def crosswalk_merge_table(spark, sf_dir):
    """Supplier codes merged into nations by a crosswalk that is a table.

    The line items are added up per supplier before they meet the crosswalk.
    """
    areas = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("area")
    ).agg(F.sum("l_quantity").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("n"))
    pairs = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("from"),
        F.concat(F.lit("N"), number_key("s_nationkey", 2)).alias("to"),
    )
    return K.merge_keys(areas, "area", pairs, ["qty", "n"])


@query(f"""WITH {_NATIONS} SELECT area, c_mktsegment, n FROM nations
  UNION ALL SELECT t.a, c_mktsegment, n FROM nations, (VALUES ('91'), ('92')) t(a)
    WHERE area = '05'""")
def crosswalk_replicate(spark, sf_dir):
    return K.replicate_keys(
        _by_nation(spark, sf_dir).select("area", "c_mktsegment", "n"), "area", SPLIT
    )


@query("""WITH s AS (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS area, count(*) AS n
    FROM supplier GROUP BY 1),
  pairs AS (SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS area, c_mktsegment
    FROM customer)
  SELECT area, n FROM s UNION ALL
  SELECT area || '-' || c_mktsegment, n FROM s JOIN pairs USING (area)""")
def crosswalk_replicate_table(spark, sf_dir):
    """Nation figures handed to the market segments found in the data."""
    areas = table(spark, sf_dir, "supplier").groupBy(
        number_key("s_nationkey", 2).alias("area")
    ).agg(F.count(F.lit(1)).alias("n"))
    pairs = table(spark, sf_dir, "customer").select(
        number_key("c_nationkey", 2).alias("from"), "c_mktsegment"
    ).distinct().withColumn("to", F.concat_ws("-", "from", "c_mktsegment"))
    return K.replicate_keys(areas, "area", pairs.select("from", "to"))


_MEMBERS = "(VALUES ('99', '01'), ('99', '02'), ('98', '02'), ('98', '04'), ('98', '06')) m(p, a)"


@query(f"""WITH {_NATIONS} SELECT area, c_mktsegment, n, round(balance, 4) AS balance FROM nations
  UNION ALL SELECT p, c_mktsegment, CAST(sum(n) AS BIGINT), round(sum(balance), 4)
    FROM nations JOIN {_MEMBERS} ON a = area GROUP BY p, c_mktsegment""")
def crosswalk_rollup_sum(spark, sf_dir):
    rolled = K.roll_up(_by_nation(spark, sf_dir), "area", PARENTS, by=["c_mktsegment"])
    return rolled.withColumn("balance", F.round("balance", 4))


@query(f"""WITH {_NATIONS}, d AS (SELECT area, c_mktsegment, CAST(n AS DOUBLE) AS n,
    balance FROM nations)
  SELECT area, c_mktsegment, n, round(balance, 4) AS balance FROM d
  UNION ALL SELECT p, c_mktsegment, round(avg(n), 6), round(avg(balance), 4)
    FROM d JOIN {_MEMBERS} ON a = area GROUP BY p, c_mktsegment""")
def crosswalk_rollup_mean(spark, sf_dir):
    areas = _by_nation(spark, sf_dir).withColumn("n", F.col("n").cast("double"))
    rolled = K.roll_up(areas, "area", PARENTS, by=["c_mktsegment"], how="mean")
    return rolled.withColumn("balance", F.round("balance", 4))


@query(f"""WITH {_NATIONS} SELECT p AS area, c_mktsegment,
    round(sum(balance * n) / sum(n), 4) AS balance, CAST(sum(n) AS BIGINT) AS n
    FROM nations JOIN {_MEMBERS} ON a = area GROUP BY p, c_mktsegment""")
def crosswalk_rollup_weighted(spark, sf_dir):
    rows = K.roll_up_rows(
        _by_nation(spark, sf_dir), "area", PARENTS, by=["c_mktsegment"], weight="n"
    )
    return rows.withColumn("balance", F.round("balance", 4))


@query("""WITH RECURSIVE steps AS (SELECT s_suppkey AS f, s_suppkey // 3 AS t FROM supplier
    WHERE s_suppkey >= 3),
  paths AS (SELECT f, t FROM steps UNION ALL
    SELECT paths.f, steps.t FROM paths JOIN steps ON steps.f = paths.t),
  last AS (SELECT f, t FROM paths WHERE t NOT IN (SELECT f FROM steps))
  SELECT CAST(coalesce(t, l_suppkey) AS VARCHAR) AS area, CAST(sum(l_quantity) AS BIGINT) AS qty,
    count(*) AS n FROM lineitem LEFT JOIN last ON f = l_suppkey GROUP BY 1""")
def crosswalk_chains(spark, sf_dir):
    """Codes that change again and again, followed to the last one in a table of changes."""
    areas = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("area")
    ).agg(F.sum("l_quantity").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("n"))
    steps = table(spark, sf_dir, "supplier").filter("s_suppkey >= 3").select(
        F.col("s_suppkey").cast("string").alias("from"),
        F.expr("s_suppkey div 3").cast("string").alias("to"),
    )
    return K.merge_keys(areas, "area", steps, ["qty", "n"], chains=True)


@query("""WITH s AS (SELECT 'S' || s_suppkey AS area, 'N' || s_nationkey AS nation,
    'R' || n_regionkey AS region, CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey
    GROUP BY ALL)
  SELECT area, qty, n FROM s
  UNION ALL SELECT nation, CAST(sum(qty) AS BIGINT), CAST(sum(n) AS BIGINT) FROM s GROUP BY 1
  UNION ALL SELECT region, CAST(sum(qty) AS BIGINT), CAST(sum(n) AS BIGINT) FROM s GROUP BY 1
  UNION ALL SELECT 'all', CAST(sum(qty) AS BIGINT), CAST(sum(n) AS BIGINT) FROM s""")
def crosswalk_rollup_nested(spark, sf_dir):
    """Suppliers, their nations, those nations' regions and all of them in one aggregation."""
    areas = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("n"),
    ).select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("area"), "qty", "n")

    def pairs(name, below, above, start, end):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(start), F.col(below).cast("string")).alias("from"),
            F.concat(F.lit(end), F.col(above).cast("string")).alias("to"))

    tree = pairs("supplier", "s_suppkey", "s_nationkey", "S", "N").union(
        pairs("nation", "n_nationkey", "n_regionkey", "N", "R")
    ).union(table(spark, sf_dir, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")), F.lit("all")))
    return K.roll_up(areas, "area", tree, nested=True)


# --- Joins --------------------------------------------------------------------


@query("""WITH early AS (SELECT o_custkey, count(*) AS n_early FROM orders
    WHERE o_orderdate < TIMESTAMP '1995-09-01' GROUP BY 1),
  late AS (SELECT o_custkey, count(*) AS n_late FROM orders
    WHERE o_orderdate >= TIMESTAMP '1995-09-01' GROUP BY 1)
  SELECT coalesce(early.o_custkey, late.o_custkey) AS o_custkey, n_early, n_late
  FROM early FULL JOIN late ON early.o_custkey = late.o_custkey""")
def full_outer_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")

    def counted(condition, name):
        return orders.filter(condition).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(name))

    day = F.col("o_orderdate")
    turn = F.lit("1995-09-01").cast("timestamp_ntz")
    early, late = counted(day < turn, "n_early"), counted(day >= turn, "n_late")
    return J.full_join(early, late, ["o_custkey"])


@query("""WITH k AS (SELECT l_partkey AS part, CASE l_returnflag WHEN 'N' THEN NULL
      ELSE l_returnflag END AS flag, l_linestatus, l_quantity FROM lineitem),
  f AS (SELECT part, flag, CAST(sum(l_quantity) AS BIGINT) AS qty_f FROM k
    WHERE l_linestatus = 'F' GROUP BY ALL),
  o AS (SELECT part, flag, CAST(sum(l_quantity) AS BIGINT) AS qty_o FROM k
    WHERE l_linestatus <> 'F' GROUP BY ALL)
  SELECT coalesce(f.part, o.part) AS part, coalesce(f.flag, o.flag) AS flag, qty_f, qty_o
  FROM f FULL JOIN o ON f.part IS NOT DISTINCT FROM o.part
    AND f.flag IS NOT DISTINCT FROM o.flag""")
def full_outer_null_keys(spark, sf_dir):
    """Two-column key of which one part is often NULL; NULL matches NULL."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part"), F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        "l_linestatus", "l_quantity",
    )

    def side(rows, name):
        return items.filter(rows).groupBy("part", "flag").agg(
            F.sum("l_quantity").cast("bigint").alias(name)
        )

    finished = F.col("l_linestatus") == "F"
    return J.full_join(side(finished, "qty_f"), side(~finished, "qty_o"), ["part", "flag"])


@query("""SELECT c_custkey, CASE n_name WHEN 'NATION_3' THEN 'Third Nation' ELSE n_name END
      AS nation, CASE n_name WHEN 'NATION_4' THEN 'Borders changed.' ELSE '' END AS note, r_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""")
def lookup_enrich(spark, sf_dir):
    named = J.left_lookup(
        J.left_lookup(
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
            table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"},
        ),
        table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"},
    )
    return named.select(
        "c_custkey", repair_names("n_name", {"NATION_3": "Third Nation"}).alias("nation"),
        notes("n_name", {"NATION_4": "Borders changed."}).alias("note"), "r_name",
    )


@query("""SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation
    ON nullif(c_nationkey, 3) IS NOT DISTINCT FROM nullif(n_nationkey, 3)""")
def lookup_null_keys(spark, sf_dir):
    """A missing key finds the entry of the lookup that has no key."""
    customer, nation = (table(spark, sf_dir, t) for t in ("customer", "nation"))
    return J.left_lookup(
        customer.select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("key")),
        nation.select(F.nullif("n_nationkey", F.lit(3)).alias("code"), "n_name", "n_regionkey"),
        {"key": "code"},
    ).drop("key")


@query("""WITH codes AS (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0')
      || lpad(CAST(s_suppkey AS VARCHAR), 3, '0') AS fips, s_nationkey, s_name FROM supplier)
  SELECT fips, n_name AS stabbrev, s_name AS countynm, qty FROM (
    SELECT fips, s_nationkey, s_name, CAST(sum(l_quantity) AS BIGINT) AS qty
    FROM lineitem JOIN codes ON l_suppkey = CAST(substring(fips, 3) AS BIGINT)
    GROUP BY ALL) JOIN nation ON n_nationkey = s_nationkey""")
def area_code_names(spark, sf_dir):
    """Names from a code table whose key is state code plus county code."""
    supplier, nation = (table(spark, sf_dir, t) for t in ("supplier", "nation"))
    codes = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        number_key("s_nationkey", 2).alias("state_code"),
        number_key("s_suppkey", 3).alias("county_code"),
        F.col("n_name").alias("state"), F.col("s_name").alias("county"), "s_suppkey",
    )
    areas = (
        table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
        .agg(F.sum("l_quantity").cast("bigint").alias("qty"))
        .join(codes, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.concat("state_code", "county_code").alias("fips"), "qty")
    )
    return area_names(areas, "fips", codes)


@query("""WITH u AS (SELECT user_id, CAST(ts AS DATE) AS d, avg(value) AS v
    FROM events GROUP BY ALL),
  a AS (SELECT CAST(ts AS DATE) AS d, avg(value) AS overall FROM events GROUP BY ALL)
  SELECT user_id, CAST(d AS VARCHAR) AS day, round(v, 6) AS daily,
    round(overall, 6) AS overall FROM u LEFT JOIN a USING (d)""")
def context_attach(spark, sf_dir):
    """Daily mean per user beside the daily mean over all users."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), "value"
    )
    users = events.groupBy("user_id", "day").agg(F.avg("value").alias("daily"))
    overall = events.groupBy("day").agg(F.avg("value").alias("overall"))
    return J.attach_context(users, overall, "day")


@query("""WITH u AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events
    WHERE dayofweek(ts) BETWEEN 1 AND 5 GROUP BY ALL),
  a AS (SELECT CAST(ts AS DATE) AS d, count(*) AS overall FROM events GROUP BY ALL)
  SELECT user_id, CAST(d AS VARCHAR) AS day, n, overall FROM u FULL JOIN a USING (d)""")
def context_all_periods(spark, sf_dir):
    """Users on working days; week-ends, which no user row has, keep the overall value."""
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    overall = events.groupBy("day").agg(F.count(F.lit(1)).alias("overall"))
    working = events.filter(F.dayofweek("day").between(2, 6))
    users = working.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    return J.attach_context(users, overall, "day", keep_unmatched=True)


@query("""SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS qty,
    round((SELECT avg(l_discount) FROM lineitem), 6) AS overall_discount,
    (SELECT count(*) FROM lineitem) AS overall_n FROM lineitem GROUP BY l_suppkey""")
def scalar_attach(spark, sf_dir):
    """One overall row beside every supplier."""
    items = table(spark, sf_dir, "lineitem")
    overall = items.agg(
        F.avg("l_discount").alias("overall_discount"), F.count(F.lit(1)).alias("overall_n")
    )
    suppliers = items.groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("qty"))
    return J.attach_one_row(suppliers, overall)


@query("""SELECT o_orderkey, o_custkey, n_orders, CAST(n_finished AS BIGINT) AS n_finished
    FROM orders JOIN (SELECT o_custkey, count(*) AS n_orders,
      count(*) FILTER (WHERE o_orderstatus = 'F') AS n_finished FROM orders GROUP BY 1)
    USING (o_custkey)""")
def group_total_attached(spark, sf_dir):
    """Customer totals written to each of the customer's orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return J.attach_group_values(orders, ["o_custkey"], [
        F.count(F.lit(1)).alias("n_orders"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("n_finished"),
    ]).drop("o_orderstatus")
