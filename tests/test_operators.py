"""Reshape, joins, crosswalks, categories and series on hand-made frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geopanel.constants import CATEGORY_ITEMS, LAST_ITEM, REALLOCATION_FACTORS
from geopanel.operators import categories as C
from geopanel.operators import columns as L
from geopanel.operators import crosswalk as K
from geopanel.operators import enrich as E
from geopanel.operators import joins as J
from geopanel.operators import reshape as R
from geopanel.operators import series as S
from geopanel.operators.enrich import outside_state
from tests.conftest import plan


# --- Columns and reshaping ----------------------------------------------------


def test_relocate(spark):
    df = spark.createDataFrame([], "a int, CEN_X int, b int, pct_x int")
    out = L.relocate(df, "b", L.containing(df, "cen_"), L.containing(df, "PCT_"), "b")
    assert out.columns == ["b", "CEN_X", "pct_x", "a"]


def test_bind_rows(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, k int")
    assert rows(L.bind_rows(a, b)) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "k int")
    with pytest.raises(PySparkException):
        L.bind_rows(a, c).collect()
    assert rows(L.bind_rows(a, c, fill=True)) == [(1, "x"), (3, None)]


def test_long_and_back(spark, rows):
    wide = spark.createDataFrame([("a", 1, 2.5), ("b", None, 4.0)], "id string, x int, y double")
    long = R.to_long(wide, ["id"], ["x", "y"])
    assert long.count() == 4
    back = R.to_wide(long, ["id"], "variable", "value", {"x": "x2", "y": "y2"})
    assert rows(back) == [("a", 1.0, 2.5), ("b", None, 4.0)]


def test_to_wide_rejects_repeated_cells(spark):
    long = spark.createDataFrame([("a", "x", 1), ("a", "x", 1)], "id string, c string, v int")
    with pytest.raises(PySparkException, match="repeated"):
        R.to_wide(long, ["id"], "c", "v", ["x"]).collect()


def test_whole_numbers_stay_exact(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([("a", big, 1)], "id string, EST_X bigint, CEN_X int")
    [row] = R.source_panel(df, ["id"], ["X"]).collect()
    assert (row.EST, row.CEN) == (big, 1)
    assert {r.value for r in R.to_long(df, ["id"], ["EST_X", "CEN_X"]).collect()} == {big, 1}
    sides = [df.select("id", F.col(c).alias("X")) for c in ("EST_X", "CEN_X")]
    [row] = E.compare_long(*sides, ["id"], ["X"]).collect()
    assert (row.EST, row.CEN) == (big, 1)


def test_source_panel_equals_split_and_pivot(spark, rows):
    wide = spark.createDataFrame(
        [("a", 1, 2, 3, 4)], "id string, EST_P_TOT int, CEN_P_TOT int, EST_Q int, CEN_Q int"
    )
    direct = R.source_panel(wide, ["id"], ["P_TOT", "Q"])
    stepwise = R.to_wide(
        R.split_source(R.to_long(wide, ["id"], wide.columns[1:])),
        ["id", "variable"], "source", "value", ["EST", "CEN"],
    )
    assert rows(direct) == rows(stepwise) == [("a", "P_TOT", 1.0, 2.0), ("a", "Q", 3.0, 4.0)]


# --- Joins --------------------------------------------------------------------


def test_full_join_matches_null_keys(spark, rows):
    a = spark.createDataFrame([("x", None, 1), ("y", "n", 2)], "k string, n string, a int")
    b = spark.createDataFrame([("x", None, 3), ("z", None, 4)], "k string, n string, b int")
    expected = [("x", None, 1, 3), ("y", "n", 2, None), ("z", None, None, 4)]
    assert rows(J.full_join(a, b, ["k", "n"])) == expected
    assert rows(J.combine_sources([a, b], ["k", "n"])) == expected


def test_full_join_of_frames_with_one_origin(spark, rows):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    low = df.filter("v = 1").withColumnRenamed("v", "low")
    high = df.filter("v = 2").withColumnRenamed("v", "high")
    assert rows(J.full_join(low, high, ["k"])) == [("x", 1, None), ("y", None, 2)]


def test_combine_sources_rejects_repeated_keys(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3)], "k string, b int")
    with pytest.raises(PySparkException, match="twice"):
        J.combine_sources([a, b], ["k"]).collect()


def test_left_lookup_keeps_unmatched(spark, rows):
    df = spark.createDataFrame([("x", 1), ("q", 2)], "k string, v int")
    look = spark.createDataFrame([("x", "Ex")], "code string, name string")
    assert rows(J.left_lookup(df, look, {"k": "code"})) == [("q", 2, None), ("x", 1, "Ex")]


def test_attach_one_row(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    us = spark.createDataFrame([(9.5, "all")], "rate double, name string")
    assert rows(J.attach_one_row(df, us)) == [(1, 9.5, "all"), (2, 9.5, "all")]
    with pytest.raises(Exception, match="More than one row"):
        J.attach_one_row(df, us.union(us)).collect()


def test_attach_context(spark, rows):
    df = spark.createDataFrame([("a", 2010), ("b", 2020), ("c", 2030)], "k string, year int")
    us = spark.createDataFrame([(2010, 1.0), (2020, 2.0), (2040, 4.0)], "year int, us double")
    left = [("a", 2010, 1.0), ("b", 2020, 2.0), ("c", 2030, None)]
    assert rows(J.attach_context(df, us, "year")) == left
    full = J.attach_context(df, us, "year", keep_unmatched=True)
    assert rows(full) == [*left, (None, 2040, 4.0)]
    nulls = spark.createDataFrame([("a", None)], "k string, year int")
    unknown = spark.createDataFrame([(None, 7.0)], "year int, us double")
    assert rows(J.attach_context(nulls, unknown, "year")) == [("a", None, 7.0)]
    both = J.attach_context(nulls, unknown, "year", keep_unmatched=True)
    assert rows(both) == [("a", None, 7.0)]


def test_null_keys_and_repeated_keys_of_lookups(spark, rows):
    df = spark.createDataFrame([("x", 1), (None, 2), ("q", 3)], "k string, v int")
    look = spark.createDataFrame([("x", "Ex"), (None, "none")], "code string, name string")
    found = J.left_lookup(df, look, {"k": "code"})
    assert rows(found) == [("q", 3, None), ("x", 1, "Ex"), (None, 2, "none")]
    with pytest.raises(PySparkException, match="occurs twice"):
        J.left_lookup(df, look.union(look), {"k": "code"}).collect()


def test_full_join_rejects_repeated_keys(spark, rows):
    left = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    right = spark.createDataFrame([(None, 5), ("z", 6)], "k string, b int")
    assert rows(J.full_join(left, right, ["k"])) == [
        ("x", 1, None), ("z", None, 6), (None, 2, 5)]
    with pytest.raises(PySparkException, match="occurs twice"):
        J.full_join(left, right.union(right), ["k"]).collect()


def test_combined_sources_keep_their_texts(spark, rows):
    one = spark.createDataFrame([("a", "Ann", 1), (None, "Nobody", 2)], "k string, name string, n int")
    two = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "k string, x double")
    out = J.combine_sources([one, two], ["k"])
    assert rows(out) == [("a", "Ann", 1, 5.0), ("b", None, None, 6.0), (None, "Nobody", 2, None)]
    with pytest.raises(PySparkException, match="occurs twice"):
        J.combine_sources([one, two.union(two)], ["k"]).collect()


def test_attach_context_rejects_repeated_periods(spark):
    df = spark.createDataFrame([("a", 2010)], "k string, year int")
    us = spark.createDataFrame([(2010, 1.0), (2010, 2.0)], "year int, us double")
    with pytest.raises(PySparkException, match="more than one row"):
        J.attach_context(df, us, "year").collect()


def test_attach_group_values(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    out = J.attach_group_values(df, ["k"], [F.sum("v").alias("total")])
    assert rows(out) == [("a", 1, 3), ("a", 2, 3), ("b", 5, 5)]


# --- Crosswalks ---------------------------------------------------------------


@pytest.fixture
def areas(spark):
    return spark.createDataFrame(
        [("51515", 1, 10.0), ("51019", 2, 20.0), ("02270", 3, None), ("01001", 4, 40.0)],
        "GEOID string, n int, x double",
    )


def _pairs(spark, mapping):
    return spark.createDataFrame(
        [(k, t) for k, v in mapping.items() for t in ([v] if isinstance(v, str) else v)],
        "`from` string, `to` string",
    )


@pytest.mark.parametrize("as_table", [False, True])
def test_merge(spark, rows, areas, as_table):
    mapping = {"51515": "51019", "02270": "02158"}
    crosswalk = _pairs(spark, mapping) if as_table else mapping
    out = K.merge_keys(areas, "GEOID", crosswalk)
    assert rows(out) == [("01001", 4, 40.0), ("02158", 3, None), ("51019", 3, 30.0)]
    assert out.agg(F.sum("n")).collect()[0][0] == areas.agg(F.sum("n")).collect()[0][0]


@pytest.mark.parametrize("as_table", [False, True])
def test_replicate(spark, rows, areas, as_table):
    mapping = {"01001": ["01002", "01003"]}
    crosswalk = _pairs(spark, mapping) if as_table else mapping
    out = rows(K.replicate_keys(areas, "GEOID", crosswalk), "GEOID", "n")
    assert len(out) == areas.count() + 2
    assert [r for r in out if r[1] == 4] == [("01001", 4), ("01002", 4), ("01003", 4)]


@pytest.mark.parametrize("as_table", [False, True])
def test_roll_up(spark, rows, areas, as_table):
    members = {"99999": ["51515", "51019"], "99998": ["51019", "02270"]}
    table = spark.createDataFrame(
        [(c, p) for p, codes in members.items() for c in codes], "`from` string, `to` string"
    )
    crosswalk = table if as_table else members
    out = K.roll_up(areas, "GEOID", crosswalk)
    new = [r for r in rows(out) if r[0].startswith("9999")]
    # A member without a figure makes the parent's figure missing.
    assert new == [("99998", 5, None), ("99999", 3, 30.0)]
    assert out.count() == areas.count() + 2
    assert [r for r in rows(out) if not r[0].startswith("9999")] == rows(areas)
    with pytest.raises(PySparkException, match="occurs twice"):
        K.roll_up(areas.union(areas), "GEOID", crosswalk).collect()
    named = K.roll_up(
        areas.withColumn("t", F.concat(F.lit("t"), "GEOID")), "GEOID", crosswalk,
        labels={"t": {"99999": "All"}}, mark="new",
    )
    assert [r for r in rows(named, "GEOID", "t", "n", "new") if r[3]] == [
        ("99998", None, 5, True), ("99999", "All", 3, True)]
    mean = K.roll_up_rows(areas, "GEOID", {"99999": ["51515", "51019"]}, how="mean")
    assert rows(mean) == [("99999", 1.5, 15.0)]


def test_roll_up_weighted_and_empty(rows, areas):
    out = K.roll_up_rows(
        areas, "GEOID", {"99999": ["51515", "51019"]}, weight="n", columns=["x"]
    )
    assert rows(out) == [("99999", pytest.approx(50 / 3))]
    assert K.roll_up_rows(areas, "GEOID", {"99999": ["77777"]}).count() == 0


# --- Categories ---------------------------------------------------------------


def test_category_items_cover_the_table():
    multi = CATEGORY_ITEMS["multi_race"]
    assert len(multi) == 52
    singles = [i for k, v in CATEGORY_ITEMS.items() if k != "multi_race" for i in v]
    assert not set(multi) & set(singles)
    # What is left are subtotals.
    left = set(range(1, LAST_ITEM + 1)) - set(multi) - set(singles)
    assert left == {3, 4, 11, 12, 28, 49, 65, 72}


def test_code_list(spark, rows):
    codes = C.code_list("P2_", "N")
    assert (codes[0], codes[-1], len(codes)) == ("P2_001N", "P2_073N", 73)
    assert [r[1] for r in sorted(rows(C.code_rows(spark, "P2_", "N")))] == codes


def test_decode_code(one):
    fields = C.decode_code("c")
    assert [one(fields[k], c="P2_017N") for k in ("table", "item", "age")] == ["2", "17", "total"]
    assert one(fields["age"], c="P4_017N") == "over17"


def test_collapse_needs_every_code(spark, rows):
    long = spark.createDataFrame(
        [("a", "05", 3), ("a", "17", 4), ("b", "05", 1), ("c", "05", None), ("c", "17", 2)],
        "id string, code string, v bigint",
    )
    out = C.collapse_categories(long, ["id"], "code", "v", {"white": ["05", "17"]})
    assert rows(out) == [("a", 7), ("b", None), ("c", None)]
    doubled = long.union(long)
    with pytest.raises(PySparkException, match="repeated"):
        C.collapse_categories(doubled, ["id"], "code", "v", {"white": ["05", "17"]}).collect()
    # A repeated code does not stand in for a missing one.
    stand_in = spark.createDataFrame([("a", "05", 1), ("a", "05", 2)], long.schema)
    with pytest.raises(PySparkException, match="repeated"):
        C.collapse_categories(stand_in, ["id"], "code", "v", {"white": ["05", "17"]}).collect()


def test_collapse_of_many_codes(spark, rows):
    codes = [f"c{i:03d}" for i in range(200)]
    long = spark.createDataFrame([("a", c, 1) for c in codes] + [("b", c, 1) for c in codes[1:]],
                                 "id string, code string, v bigint")
    assert rows(C.collapse_categories(long, ["id"], "code", "v", {"all": codes})) == [
        ("a", 200), ("b", None)]
    more = long.union(spark.createDataFrame([("b", codes[150], 1)], long.schema))
    with pytest.raises(PySparkException, match="repeated"):
        C.collapse_categories(more, ["id"], "code", "v", {"all": codes}).collect()


def test_reallocation_keeps_the_total(spark):
    groups = list(REALLOCATION_FACTORS)
    columns = ", ".join(f"{g}_base bigint" for g in groups)
    data = [(other, *range(6)) for other in [0, 1, 2, 3, 7, 99, 1000, 123457]]
    df = spark.createDataFrame(data, f"other bigint, {columns}")
    out = C.reallocate(
        df, "other", REALLOCATION_FACTORS, {g: f"{g}_base" for g in groups}, "white",
        {g: g for g in groups},
    ).collect()
    for r in out:
        assert sum(r[g] for g in groups) == r.other + 15
    by_hand = {r.other: r for r in out}[1000]
    assert [by_hand[g] - i for i, g in enumerate(groups)] == [598, 248, 12, 108, 6, 28]
    # 99: parts 59, 25, 1, 11, 1, 3 add up to 100, so white gives one back.
    ninety_nine = {r.other: r for r in out}[99]
    assert [ninety_nine[g] - i for i, g in enumerate(groups)] == [58, 25, 1, 11, 1, 3]


# --- Series -------------------------------------------------------------------


def test_week_range():
    year = S.week_range(dt.date(2020, 1, 1), dt.date(2021, 1, 1))
    assert year == (dt.date(2020, 1, 5), dt.date(2020, 12, 27))
    # Both ends are outside.
    assert S.week_range(dt.date(2020, 1, 5), dt.date(2020, 1, 12)) is None
    assert S.week_range(dt.date(2020, 1, 4), dt.date(2020, 1, 13)) == (
        dt.date(2020, 1, 5), dt.date(2020, 1, 12))
    assert S.week_range(dt.date(2020, 1, 4), dt.date(2020, 1, 12)) == (dt.date(2020, 1, 5),) * 2


def test_weekly_sample_equals_generated_weeks(spark):
    days = spark.sql("SELECT explode(sequence(date'2019-12-01', date'2021-02-01')) AS d")
    out = S.weekly_sample(days, "d", dt.date(2020, 1, 1), dt.date(2021, 1, 1))
    first, last = S.week_range(dt.date(2020, 1, 1), dt.date(2021, 1, 1))
    assert sorted(r.d for r in out.collect()) == [
        first + dt.timedelta(weeks=w) for w in range(52)]
    assert last == first + dt.timedelta(weeks=51)


def test_densify(spark, rows):
    days = [dt.date(2020, 1, 5), dt.date(2020, 1, 12), dt.date(2020, 1, 19)]
    areas = spark.createDataFrame([("a",), ("b",)], "k string")
    us = spark.createDataFrame([(days[0], 1.0), (days[1], 2.0)], "d date, us double")
    facts = spark.createDataFrame([("a", days[0], 5.0), ("z", days[0], 9.0)],
                                  "k string, d date, v double")
    out = S.densify(areas, us, facts, "k", "d", (days[0], days[2]))
    # The third day has no overall value, so it is not in the calendar.
    assert rows(out, "k", "d", "us", "v") == [
        ("a", days[0], 1.0, 5.0), ("a", days[1], 2.0, None),
        ("b", days[0], 1.0, None), ("b", days[1], 2.0, None),
    ]


def test_decode_series(spark, rows):
    df = spark.createDataFrame(
        [
            ("LAUCN010010000000003", 2020, "M01", 3.1), ("LAUCN010010000000003", 2020, "M13", 9.9),
            ("LAUCN010010000000003", 2019, "M01", 9.9), ("LAUCN010010000000004", 2020, "M01", 9.9),
            ("LAUST010010000000003", 2020, "M01", 9.9),
        ],
        "series_id string, year int, period string, value double",
    )
    assert rows(S.decode_series(df, 2020)) == [("01001", "01/01/20", 3.1)]
    assert rows(S.decode_series(df, 2020, area_width=6)) == [("010010", "01/01/20", 3.1)]


def test_percent_of_base(spark, rows):
    df = spark.createDataFrame(
        [("a", "part", 1.0), ("a", "total", 4.0), ("b", "part", 1.0), ("c", "total", 0.0),
         ("c", "part", 0.0), ("a", "other", 7.0)],
        "k string, c string, v double",
    )
    out = S.percent_of_base(df, ["k"], "c", "v", "part", "total", "pct")
    assert rows(out) == [("a", 25.0), ("b", None), ("c", None)]


def test_outside_state(spark, rows):
    df = spark.createDataFrame([("72001",), ("01072",), (None,)], "GEOID string")
    assert rows(df.filter(outside_state("GEOID"))) == [("01072",)]


# --- Checked and chained code changes ---


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(
        [("a", 1), ("b", 2), ("c", 4), ("d", 8), (None, 16)], "code string, n bigint")


def _steps(spark, *pairs):
    return spark.createDataFrame(list(pairs), "from string, to string")


CHAIN = [("a", "b"), ("b", "c"), ("c", "x"), ("d", "d"), (None, "a")]


def test_chains_of_changes(spark, counts, rows):
    tables = {"dict": {f: t for f, t in CHAIN if f}, "table": _steps(spark, *CHAIN)}
    for chains in (True, False):
        expected = [("d", 8), ("x", 7), (None, 16)] if chains else [
            ("b", 1), ("c", 2), ("d", 8), ("x", 4), (None, 16)]
        for crosswalk in tables.values():
            assert rows(K.merge_keys(counts, "code", crosswalk, chains=chains)) == expected
    long = [(str(i), str(i + 1)) for i in range(37)]
    last = K.last_codes(_steps(spark, *long))
    assert rows(last) == sorted((f, "37") for f, _ in long)
    assert K.last_codes(dict(long)) == {f: "37" for f, _ in long}


@pytest.mark.parametrize("circle", [
    [("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b")]])
def test_circles_are_errors(spark, counts, circle):
    with pytest.raises(ValueError, match="back to it"):
        K.recode_keys(counts, "code", _steps(spark, *circle), chains=True)
    with pytest.raises(ValueError, match="back to it"):
        K.recode_keys(counts, "code", dict(circle), chains=True)
    with pytest.raises(ValueError, match="back to it"):
        K.roll_up(counts, "code", _steps(spark, *circle), nested=True)
    with pytest.raises(ValueError, match="back to it"):
        K.roll_up(counts, "code", {t: [f] for f, t in circle}, nested=True)


def test_repeated_pairs_are_errors(spark, counts):
    twice = _steps(spark, ("a", "x"), ("a", "y"))
    same = _steps(spark, ("a", "x"), ("a", "x"))
    for crosswalk in (twice, same):
        with pytest.raises(PySparkException, match="occurs twice"):
            K.merge_keys(counts, "code", crosswalk).collect()
    assert K.replicate_keys(counts, "code", twice).count() == 7
    for operator in (K.replicate_keys, K.roll_up, K.roll_up_rows):
        with pytest.raises(PySparkException, match="occurs twice"):
            operator(counts, "code", same).collect()


def test_trees_of_any_depth_roll_up_at_once(spark, counts, rows):
    tree = [("a", "p"), ("b", "p"), ("p", "q"), ("c", "q"), ("q", "r"), ("d", "r"), ("a", "q")]
    expected = [("a", 1), ("b", 2), ("c", 4), ("d", 8), ("p", 3), ("q", 7), ("r", 15), (None, 16)]
    assert rows(K.roll_up(counts, "code", _steps(spark, *tree), nested=True)) == expected
    members = {}
    for member, parent in tree:
        members.setdefault(parent, []).append(member)
    out = K.roll_up(counts, "code", members, nested=True)
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert rows(out) == expected


def test_roll_up_refuses_columns_it_would_lose(spark, counts, rows):
    dated = counts.withColumns({"name": F.upper("code"), "day": F.current_date()})
    with pytest.raises(ValueError, match="name.*day"):
        K.roll_up(dated, "code", {"p": ["a", "b"]})
    out = K.roll_up(dated, "code", {"p": ["a", "b"]}, labels={"name": {"p": "P"}, "day": {}})
    assert out.columns == ["code", "n", "name", "day"]
    assert dict(out.dtypes)["day"] == "date"
    assert ("p", 3, "P") in rows(out, "code", "n", "name")


# --- Uniqueness without passes of its own ---


def _scanned(df):
    text = plan(df)
    return text.count("FileScan"), text.count("Exchange hashpartitioning")


def test_unique_keys_cost_no_pass(spark, tmp_path, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("l", "r"):
            spark.createDataFrame([(1, name, 5), (None, name, 6)], f"k int, {name}t string, {name}n int") \
                .write.parquet(f"{tmp_path}/{name}")
        left, right = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("l", "r"))
        both = J.full_join(left, right, ["k"])
        # Numbers once, texts once: three shuffles, of which none is for the check.
        assert _scanned(both) == (4, 3)
        assert _scanned(J.full_join(left.drop("lt"), right.drop("rt"), ["k"])) == (2, 1)
        assert rows(both) == [(1, "l", 5, "r", 5), (None, "l", 6, "r", 6)]
        assert _scanned(J.left_join_unique(left, right, ["k"])) == (2, 2)
        assert rows(J.left_join_unique(left, right, ["k"])) == rows(both)
        # The lookup is read once, and the join has shuffles of its own for hot keys.
        assert _scanned(J.left_lookup(left, right, ["k"])) == (2, 3)
        assert rows(J.left_lookup(left, right, ["k"])) == rows(both)
        twice = right.union(right)
        for join in (J.full_join, J.left_lookup, J.left_join_unique):
            with pytest.raises(PySparkException, match="occurs twice"):
                join(left, twice, ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_columns_of_two_sources_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], "k int, n int")
    with pytest.raises(ValueError, match="more than one source"):
        J.full_join(frame, frame, ["k"])


def test_densify_refuses_repeated_facts(spark, rows):
    import datetime as dt

    from geopanel.operators import series

    day = dt.date(2020, 3, 1)
    areas = spark.createDataFrame([("a",), (None,)], "code string")
    calendar = spark.createDataFrame([(day, 1)], "day date, all int")
    facts = spark.createDataFrame([("a", day, 5), (None, day, 7)], "code string, day date, n int")
    grid = series.densify(areas, calendar, facts, "code", "day", (day, day))
    assert rows(grid, "code", "all", "n") == [("a", 1, 5), (None, 1, 7)]
    with pytest.raises(PySparkException, match="occurs twice"):
        series.densify(areas, calendar, facts.union(facts), "code", "day", (day, day)).collect()
