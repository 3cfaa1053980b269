"""Text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from geopanel.catalog.inputs import table
from geopanel.catalog.registry import query
from geopanel.functions import (
    alias_code,
    as_number,
    number_key,
    pad_key,
    remove_first,
    remove_first_text,
    slice_text,
    split_first,
    title_case,
)

# The same word rule without look-around: a mark between a digit and a letter does not
# join them, so a control character is put behind it and taken out again.
_TITLE_SQL = r"""replace(array_to_string(list_transform(regexp_extract_all(
    regexp_replace(lower(%s), '(\p{N}[''’.])(\p{L})', '\1' || chr(1) || '\2', 'g'),
  '[\p{L}\p{M}\p{N}_]+(?:[''’.][\p{L}\p{M}\p{N}_]+)*|[^\p{L}\p{M}\p{N}_]+'),
  lambda t: CASE substring(t, 1, 1) WHEN 'ß' THEN 'Ss' ELSE upper(substring(t, 1, 1)) END
    || substring(t, 2)), ''), chr(1), '')"""


@query("""SELECT o_orderkey, substring(o_orderpriority, 1, strpos(o_orderpriority, '-') - 1)
    AS level, substring(o_orderpriority, strpos(o_orderpriority, '-') + 1) AS label FROM orders""")
def split_code(spark, sf_dir):
    level, label = split_first("o_orderpriority", "-")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", level.alias("level"), label.alias("label")
    )


@query("SELECT p_partkey, " + _TITLE_SQL % "upper(p_name || ' (' || p_type || '-' || p_brand || ')')"
       + " AS title FROM part")
def title_case_names(spark, sf_dir):
    raw = F.upper(F.concat("p_name", F.lit(" ("), "p_type", F.lit("-"), "p_brand", F.lit(")")))
    return table(spark, sf_dir, "part").select("p_partkey", title_case(raw).alias("title"))


@query("SELECT doc_id, " + _TITLE_SQL % "text" + " AS title FROM documents")
def title_case_texts(spark, sf_dir):
    """Whole documents in four languages."""
    return table(spark, sf_dir, "documents").select("doc_id", title_case("text").alias("title"))


@query("""SELECT o_orderkey, CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 3
      THEN lpad(CAST(o_custkey AS VARCHAR), 3, '0') ELSE CAST(o_custkey AS VARCHAR) END AS cust,
    lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS key, substring(o_orderpriority, 1, 1) AS first,
    right(o_orderpriority, 3) AS last3,
    substring(o_orderpriority, 3, 2) AS middle FROM orders""")
def key_texts(spark, sf_dir):
    """Zero padding that never cuts, and slices from either end."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", pad_key(F.col("o_custkey").cast("string"), 3).alias("cust"),
        number_key("o_orderkey", 12).alias("key"),
        slice_text("o_orderpriority", 1, 1).alias("first"),
        slice_text("o_orderpriority", -3, -1).alias("last3"),
        slice_text("o_orderpriority", 3, 4).alias("middle"),
    )


@query("""SELECT c_custkey, regexp_replace(c_name, '0+', '') AS once,
    replace(c_name, 'Customer#', '') AS bare,
    TRY_CAST(replace(c_name, 'Customer#', '') AS DOUBLE) AS number,
    TRY_CAST(c_name AS DOUBLE) AS no_number,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'bld' WHEN 'MACHINERY' THEN 'mch' END AS alias
  FROM customer""")
def text_cleaning(spark, sf_dir):
    """First match removed, text to number with failures as NULL, code aliases."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", remove_first("c_name", "0+").alias("once"),
        remove_first_text("c_name", "Customer#").alias("bare"),
        as_number(remove_first("c_name", "Customer#")).alias("number"),
        as_number("c_name").alias("no_number"),
        alias_code("c_mktsegment", {"BUILDING": "bld", "MACHINERY": "mch"}).alias("alias"),
    )
