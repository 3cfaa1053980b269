"""One test per trap in the meaning of missing values, rounding and text."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geopanel import functions as X
from geopanel.functions.aggregates import strict_mean, strict_sd, strict_sum

INF = float("inf")


@pytest.mark.parametrize("x, expected", [(0.5, 0), (1.5, 2), (2.5, 2), (-2.5, -2), (None, None)])
def test_half_even(one, x, expected):
    assert one(X.half_even("x"), x=F.lit(x).cast("double")) == expected


def test_half_even_digits(one):
    assert one(X.half_even("x", 1), x=0.25) == 0.2


@pytest.mark.parametrize("condition, expected", [(True, "y"), (False, "n"), (None, None)])
def test_if_else_null_condition(one, condition, expected):
    out = X.if_else(F.col("c"), F.lit("y"), F.lit("n"))
    assert one(out, c=F.lit(condition).cast("boolean")) == expected


def test_cases_null_condition_is_no_match(one):
    out = X.cases([(F.col("x") > 5, "high"), (F.col("x") <= 5, "low")])
    assert one(out, x=F.lit(None).cast("int")) is None
    assert one(out, x=7) == "high"
    with pytest.raises(ValueError):
        X.cases([])


def test_ratio(one):
    assert one(X.ratio("a", "b"), a=1, b=4) == 0.25
    assert one(X.ratio("a", "b"), a=1, b=0) is None
    assert one(X.ratio("a", "b"), a=0, b=0) is None
    assert one(X.ratio("a", "b", unbounded=True), a=3, b=0) == INF
    assert one(X.ratio("a", "b", unbounded=True), a=-3, b=0) == -INF
    assert one(X.ratio("a", "b", unbounded=True), a=0, b=0) is None


@pytest.mark.parametrize("x, expected", [
    (None, 0.0), (float("nan"), 0.0), (INF, 0.0), (-INF, 0.0), (1.5, 1.5), (-1.5, -1.5),
])
def test_finite_or(one, x, expected):
    assert one(X.finite_or("x", 0), x=F.lit(x).cast("double")) == expected


def test_membership_is_never_null(one):
    assert one(X.is_member("x", ["a"]), x=F.lit(None).cast("string")) is False
    assert one(X.is_member("x", ["a"]), x="a") is True


def test_strict_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", None), ("c", 5.0)], "k string, v double"
    )
    out = {
        r.k: (r.s, r.m, r.d)
        for r in df.groupBy("k").agg(
            strict_sum("v").alias("s"), strict_mean("v").alias("m"), strict_sd("v").alias("d")
        ).collect()
    }
    assert out["a"] == (4.0, 2.0, pytest.approx(2 ** 0.5))
    assert out["b"] == (None, None, None)
    assert out["c"] == (5.0, 5.0, None)  # sample sd of a single row is missing


def test_single_value(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    good = df.filter("k = 'a'").groupBy("k").agg(X.single_value("v").alias("v"))
    assert good.collect()[0].v == 1
    with pytest.raises(PySparkException, match="more than one row"):
        df.groupBy("k").agg(X.single_value("v").alias("v")).collect()


def test_numeric_columns(spark):
    df = spark.createDataFrame([], "a int, b string, c double, d date, e decimal(5,2)")
    assert X.numeric_columns(df, ["a"]) == ["c", "e"]


@pytest.mark.parametrize("text, width, expected", [
    ("7", 3, "007"), ("1234", 3, "1234"), ("", 2, "00"), (None, 2, None),
])
def test_padding_never_cuts(one, text, width, expected):
    assert one(X.pad_key("t", width), t=F.lit(text).cast("string")) == expected


def test_number_key(one):
    assert one(X.number_key("n", 3), n=7) == "007"
    assert one(X.number_key("n", 3), n=12345) == "12345"


@pytest.mark.parametrize("start, end, expected", [
    (1, 2, "P2"), (6, 11, "1N"), (-6, -6, "2"), (-3, -2, "01"),
])
def test_slice_text(one, start, end, expected):
    assert one(X.slice_text("t", start, end), t="P2_001N") == expected


def test_slice_text_needs_one_side():
    with pytest.raises(ValueError):
        X.slice_text("t", 1, -1)


def test_remove_first_only(one):
    assert one(X.remove_first("t", "USA-"), t="USA-01USA-02") == "01USA-02"
    assert one(X.remove_first("t", "0+"), t="x\n00y00") == "x\ny00"
    assert one(X.remove_first("t", "z"), t="abc") == "abc"


@pytest.mark.parametrize("text, expected", [
    ("USA-01001", "01001"), ("USA-01USA-02", "01USA-02"), ("01USA-", "01"), ("plain", "plain"),
    ("USA-", ""), ("", ""), (None, None),
])
def test_remove_first_text(one, text, expected):
    out = X.remove_first_text("t", "USA-")
    assert one(out, t=F.lit(text).cast("string")) == expected


def test_split_first(one):
    head, tail = X.split_first("t", "_")
    assert (one(head, t="EST_NH_WA_TOT"), one(tail, t="EST_NH_WA_TOT")) == ("EST", "NH_WA_TOT")
    assert (one(head, t="plain"), one(tail, t="plain")) == ("plain", None)
    head, tail = X.split_first("t", ".")
    assert one(tail, t="a.b.c") == "b.c"


@pytest.mark.parametrize("text, expected", [
    ("SEVERE STORMS, AND FLOODING", "Severe Storms, And Flooding"),
    ("STORMS-FLOODING (DR-4567)", "Storms-Flooding (Dr-4567)"),
    ("O'BRIEN'S 'QUOTED' WORD", "O'brien's 'Quoted' Word"),
    ("covid-19\tpandemic\nnow", "Covid-19\tPandemic\nNow"),
    ("2ND 1,000.5 mail5.example a_b", "2nd 1,000.5 Mail5.Example A_b"),
    ("élan ßa ﬁn", "Élan Ssa Fin"),
    ("", ""), (None, None),
])
def test_title_case(one, text, expected):
    assert one(X.title_case("t"), t=F.lit(text).cast("string")) == expected


def test_as_number(one):
    assert one(X.as_number("t"), t="70.1") == 70.1
    assert one(X.as_number("t"), t="n/a") is None


def test_sunday(one):
    assert one(X.on_weekday("d", "Sun"), d=dt.date(2020, 1, 5)) is True
    assert one(X.on_weekday("d", "Sun"), d=dt.date(2020, 1, 6)) is False


def test_alias_code(one):
    names = {"P042001": "GQ_TOT"}
    assert one(X.alias_code("c", names), c="P042001") == "GQ_TOT"
    assert one(X.alias_code("c", names), c="other") is None


def test_sum_columns(one):
    assert one(X.sum_columns(["a", "b"]), a=1, b=2) == 3
    assert one(X.sum_columns(["a", "b"]), a=1, b=F.lit(None).cast("int")) is None


def test_sql_quotes_names_and_texts(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c-d` int")
    assert df.select(X.sql("{x} + {y}", x="a b", y="c-d").alias("s")).collect()[0].s == 3
    assert spark.sql("SELECT " + X.text("it's a \\ test")).collect()[0][0] == "it's a \\ test"
