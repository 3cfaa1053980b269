"""Readers and writers, over files and texts made from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from geopanel.catalog.inputs import table
from geopanel.catalog.registry import query
from geopanel.functions import as_number
from geopanel.session import shared_folder
from geopanel.sources.coded import read_decennial, read_survey
from geopanel.sources.delimited import read_csv, read_tsv, write_csv
from geopanel.sources.header_json import parse_documents, parse_rows, read_header_json


def _rate():
    return F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))


def _rate_lines(spark, sf_dir):
    """Customers as the lines of an array of arrays, header first."""
    customer = table(spark, sf_dir, "customer")
    header = spark.range(1).select(F.lit('[["RATE","state","county"],').alias("value"))
    rows = customer.select(F.concat(
        F.lit('["'), _rate(),
        F.lit('","'), F.col("c_nationkey").cast("string"), F.lit('","'),
        F.col("c_custkey").cast("string"), F.lit('"],'),
    ).alias("value"))
    return header.unionByName(rows)


_FIELDS = {"county": "county", "state": "state", "rate": "RATE"}
_RATES = """SELECT CAST(c_custkey AS VARCHAR) AS county, CAST(c_nationkey AS VARCHAR) AS state,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS rate FROM customer"""


@query(_RATES)
def json_header_rows(spark, sf_dir):
    """One array per line; columns found by the names in the header line."""
    parsed = parse_rows(_rate_lines(spark, sf_dir), _FIELDS)
    return parsed.withColumn("rate", as_number("rate"))


@query(_RATES)
def json_file_rows(spark, sf_dir):
    """The same in one whole file per nation, read back."""
    path = shared_folder(spark, "header-json")
    customer = table(spark, sf_dir, "customer")
    last = customer.groupBy("c_nationkey").agg(F.max("c_custkey").alias("last"))
    rows = customer.join(last, "c_nationkey").select(
        "c_nationkey", "c_custkey", F.concat(
            F.lit('["'), _rate(), F.lit('","'), F.col("c_nationkey").cast("string"), F.lit('","'),
            F.col("c_custkey").cast("string"), F.lit('"]'),
            F.when(F.col("c_custkey") == F.col("last"), "]").otherwise(","),
        ).alias("value"))
    header = last.select(
        "c_nationkey", F.lit(-1).alias("c_custkey"), F.lit('[["RATE","state","county"],').alias("value"))
    lines = header.unionByName(rows).repartition("c_nationkey").sortWithinPartitions(
        "c_nationkey", "c_custkey")
    lines.select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    return read_header_json(spark, path, _FIELDS).withColumn("rate", as_number("rate"))


@query("""SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, value
    FROM events WHERE value >= 1
  UNION ALL SELECT CAST(event_id AS VARCHAR), event_type, NULL FROM events WHERE value < 1""")
def json_documents(spark, sf_dir):
    """One small document per event, each with a header of its own."""
    value = F.when(F.col("value") < 1, F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
    )
    documents = table(spark, sf_dir, "events").select(F.concat(
        F.lit('[["kind","id","value"],["'), "event_type", F.lit('","'),
        F.col("event_id").cast("string"), F.lit('",'), value, F.lit("]]"),
    ).alias("value"))
    parsed = parse_documents(documents, {"id": "id", "kind": "kind", "value": "value"})
    return parsed.withColumn("value", as_number("value"))


_ORDERS = {
    "o_orderkey": "bigint", "key": "string", "price": "double", "share": "double",
    "day": "date", "priority": "string", "note": "string",
}
_ROUND_TRIP = """SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS key,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
    CASE o_orderstatus WHEN 'F' THEN 'inf'::DOUBLE WHEN 'O' THEN '-inf'::DOUBLE END AS share,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderpriority AS priority,
    CASE WHEN o_orderstatus = 'F' THEN 'has "quotes", commas' END AS note FROM orders"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("key"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") == "F", float("inf"))
        .when(F.col("o_orderstatus") == "O", -float("inf")).alias("share"),
        F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "F", 'has "quotes", commas')
        .when(F.col("o_orderstatus") == "O", "").alias("note"),
    )


@query(_ROUND_TRIP)
def csv_round_trip(spark, sf_dir):
    """Padded keys, missing values, dates and quoted text survive a CSV file."""
    path = shared_folder(spark, "csv")
    write_csv(_orders(spark, sf_dir), path)
    return read_csv(spark, path, _ORDERS)


@query("""SELECT o_orderkey, o_orderpriority AS priority FROM orders""")
def csv_folder(spark, sf_dir):
    """A folder of several files with more columns, in another order."""
    path = shared_folder(spark, "csv-folder")
    write_csv(_orders(spark, sf_dir).repartition(3, "o_orderkey"), path)
    return read_csv(spark, path, {"priority": "string", "o_orderkey": "bigint"}).select(
        "o_orderkey", "priority")


@query("""SELECT o_orderkey, o_orderpriority || chr(10) || 'said "' || o_orderstatus || '",'
    || chr(10) || chr(10) || 'late' AS note, o_totalprice AS price FROM orders""")
def csv_quoted_lines(spark, sf_dir):
    """Notes of several lines with quotes and commas, read in splits."""
    path = shared_folder(spark, "csv-lines")
    notes = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(
            "o_orderpriority", F.lit('\nsaid "'), "o_orderstatus", F.lit('",\n\nlate'),
        ).alias("note"), F.col("o_totalprice").alias("price"))
    write_csv(notes, path)
    contract = {"o_orderkey": "bigint", "note": "string", "price": "double"}
    return read_csv(spark, path, contract, quoted_newlines=True)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, '[' || c_mktsegment || '],"' AS kind
    FROM customer""")
def json_free_rows(spark, sf_dir):
    """Brackets and quotes in values, white space between rows, one array per nation."""
    path = shared_folder(spark, "free-json")
    row = F.concat(F.lit('\n  [ "'), F.col("c_custkey").cast("string"), F.lit('" ,\n "['),
                   "c_mktsegment", F.lit('],\\"" ] '))
    answers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.concat(
        F.lit('[ ["id" , "kind"] ,'), F.array_join(F.collect_list(row), ","), F.lit("\n]\n"),
    ).alias("value"))
    answers.write.partitionBy("c_nationkey").option("lineSep", "\n").text(path)
    return read_header_json(spark, path, {"id": "id", "kind": "kind"}, "free")


_CODED = """SELECT lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS GEOID, 'Area ' || l_suppkey AS NAME,
    CASE l_linenumber {names} END AS variable, {value} FROM lineitem
  WHERE l_linenumber IN (1, 3) GROUP BY l_suppkey, l_linenumber"""


def _coded(spark, sf_dir, *values):
    """Line items as a long table of codes, per supplier and line number."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(
        *values
    ).select(
        F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("GEOID"),
        F.concat(F.lit("Area "), F.col("l_suppkey").cast("string")).alias("NAME"),
        F.concat(F.lit("P00"), F.col("l_linenumber").cast("string"), F.lit("N"))
        .alias("variable"), "*",
    ).drop("l_suppkey", "l_linenumber")


@query(_CODED.format(names="WHEN 1 THEN 'P001N' WHEN 3 THEN 'P003N'",
                     value="CAST(sum(l_quantity) AS BIGINT) AS value"))
def decennial_scan(spark, sf_dir):
    """Listed codes out of a landed table of counts."""
    path = f"{shared_folder(spark, 'decennial')}.parquet"
    _coded(spark, sf_dir, F.sum("l_quantity").cast("bigint").alias("value")).write.parquet(path)
    return read_decennial(spark, path, ["P001N", "P003N"])


@query(_CODED.format(names="WHEN 1 THEN 'first' WHEN 3 THEN 'third'",
                     value="CAST(sum(l_quantity) AS DOUBLE) AS estimate, "
                           "nullif(CAST(count(*) AS DOUBLE), 10) AS moe"))
def survey_scan(spark, sf_dir):
    """Listed codes out of landed survey files, under their names; NA is missing."""
    path = shared_folder(spark, "survey")
    write_csv(_coded(
        spark, sf_dir, F.sum("l_quantity").alias("estimate"),
        F.nullif(F.count(F.lit(1)).cast("double"), F.lit(10)).alias("moe"),
    ), path)
    return read_survey(spark, path, {"P001N": "first", "P003N": "third"})


@query(_ROUND_TRIP.replace("""'has "quotes", commas'""", "'trimmed'"))
def tsv_round_trip(spark, sf_dir):
    """Tab-separated text padded with blanks, trimmed on reading."""
    path = shared_folder(spark, "tsv")
    orders = _orders(spark, sf_dir).withColumn(
        "share", F.when(F.col("share") > 0, "Inf").when(F.col("share") < 0, "-Inf"))
    padded = orders.withColumn(
        "note", F.when(F.col("note") != "", "  trimmed  ")
    ).withColumn("priority", F.rpad("priority", 20, " "))
    padded.write.csv(
        path, sep="\t", header=True, nullValue="NA",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return read_tsv(spark, path, _ORDERS)
