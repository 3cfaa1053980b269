"""Differences, shares, bands and grades, worked out by hand or in plain Python."""

from __future__ import annotations

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from geopanel.constants import CLOSE, HIGH, SLIGHT
from geopanel.operators import bands as B
from geopanel.operators import compare as P
from geopanel.operators.reshape import source_panel

INF = float("inf")


@pytest.mark.parametrize("previous, following, expected", [
    (100, 112, 109), (0, 2, 2), (10, 10, 10), (100, 88, 91), (None, 5, None), (5, None, None),
])
def test_interpolate(one, previous, following, expected):
    out = P.interpolate("p", "f")
    assert one(out, p=F.lit(previous).cast("bigint"), f=F.lit(following).cast("bigint")) == expected


def test_size_class(one):
    def label(n):
        return one(P.size_class("n"), n=F.lit(n).cast("bigint"))

    assert [label(n) for n in (100_000, 99_999, 40_000, 39_999, 0, None)] == [
        "Large", "Medium", "Medium", "Small", "Small", None
    ]


@pytest.mark.parametrize("actual, estimate, plain, zero_rule, unbounded", [
    (10, 8, 0.25, 0.25, 0.25),
    (8, 8, 0.0, 0.0, 0.0),
    (0, 8, -1.0, 0.0, -1.0),
    (5, 0, None, None, INF),
    (0, 0, 0.0, 0.0, 0.0),
    (0, None, None, 0.0, None),
    (None, 8, None, None, None),
])
def test_share_difference(one, actual, estimate, plain, zero_rule, unbounded):
    pair = {"a": F.lit(actual).cast("bigint"), "e": F.lit(estimate).cast("bigint")}
    assert one(P.share_difference("a", "e"), **pair) == plain
    assert one(P.share_difference("a", "e", zero_if_actual_zero=True), **pair) == zero_rule
    assert one(P.share_difference("a", "e", unbounded=True), **pair) == unbounded


def test_compare_sources(spark):
    df = spark.createDataFrame([(10, 8)], "CEN_A_TOT int, EST_A_TOT int")
    out = P.compare_sources(df, {"A": "A_TOT"}).collect()[0]
    assert (out.A_DIFF, out.SHARE_A_DIFF) == (2, 0.25)


def test_per_unit_and_proportions(spark):
    df = spark.createDataFrame([(100, 10, 30, 25), (100, 10, 0, 25)], "p int, g int, u int, w int")
    out = P.proportions(df, {"share": "w"}, "p").withColumns(
        {"hh": P.household("p", "g"), "pph": P.per_unit("p", "g", "u")}
    ).collect()
    assert [(r.share, r.hh, r.pph) for r in out] == [(0.25, 90, 3.0), (0.25, 90, None)]


@pytest.mark.parametrize("change, expected", [
    (5.0, HIGH), (-5.0, HIGH), (4.99, SLIGHT), (-2.5, SLIGHT), (2.49, CLOSE), (0.0, CLOSE),
    (None, None),
])
def test_change_label(one, change, expected):
    assert one(P.change_label("c", (5.0, 2.5)), c=F.lit(change).cast("double")) == expected


# --- Bands --------------------------------------------------------------------


@pytest.mark.parametrize("actual, estimate, relative, absolute", [
    (12.0, 10.0, 0.2, 2.0), (12.0, 0.0, 0.0, 12.0), (0.0, 0.0, 0.0, 0.0),
    (None, 10.0, 0.0, 0.0), (12.0, None, 0.0, 0.0), (INF, 10.0, 0.0, 0.0),
    (float("nan"), 10.0, 0.0, 0.0),
])
def test_calibration_difference(one, actual, estimate, relative, absolute):
    pair = {"a": F.lit(actual).cast("double"), "e": F.lit(estimate).cast("double")}
    assert one(B.calibration_difference("a", "e", True), **pair) == pytest.approx(relative)
    assert one(B.calibration_difference("a", "e", False), **pair) == absolute


@pytest.mark.parametrize("actual, estimate, default, compat", [
    (12.0, 10.0, 0.2, 2 / 17), (10.0, 10.0, 0.0, 0.0), (12.0, 0.0, None, 1.0),
    (0.0, 0.0, 0.0, 0.0), (None, 1.0, None, None),
])
def test_scoring_difference(one, actual, estimate, default, compat):
    pair = {"a": F.lit(actual).cast("double"), "e": F.lit(estimate).cast("double")}
    plain = one(B.scoring_difference("a", "e", True), **pair)
    quirk = one(B.scoring_difference("a", "e", True, compat=True), **pair)
    assert plain == (None if default is None else pytest.approx(default))
    assert quirk == (None if compat is None else pytest.approx(compat))


@pytest.mark.parametrize("d, expected", [
    (2.0, HIGH), (-2.0, HIGH), (2.1, HIGH), (1.0, SLIGHT), (-1.0, SLIGHT), (1.99, SLIGHT),
    (0.99, CLOSE), (-0.99, CLOSE), (0.0, CLOSE), (None, None),
])
def test_divergence_label(one, d, expected):
    ranges = dict(zip(B.RANGES, (1.0, -1.0, 2.0, -2.0)))
    assert one(B.divergence_label("d"), d=F.lit(d).cast("double"), **ranges) == expected


def test_label_without_bands_is_missing(one):
    ranges = {r: F.lit(None).cast("double") for r in B.RANGES}
    assert one(B.divergence_label("d"), d=0.5, **ranges) is None


SCHEMA = "area int, SIZE_CLASS string, EST_N double, CEN_N double, EST_S double, CEN_S double"


def _expected(data):
    cells = {}
    for _, size, en, cn, es, cs in data:
        relative = (cn - en) / en if None not in (cn, en) and en else 0.0
        absolute = cs - es if None not in (cs, es) else 0.0
        cells.setdefault(("N", size), []).append(relative)
        cells.setdefault(("S", size), []).append(absolute)
    return {
        k: (len(v), statistics.fmean(v), statistics.stdev(v) if len(v) > 1 else None)
        for k, v in cells.items()
    }


def _check(out, expected):
    got = {(r["variable"], r.SIZE_CLASS): r for r in out.collect()}
    assert set(got) == set(expected)
    for key, (n, mean, sd) in expected.items():
        r = got[key]
        assert r["count"] == n
        assert r["mean"] == pytest.approx(mean, abs=1e-9)
        if sd is None:
            assert (r.sd, r.range_1_high, r.range_2_low) == (None, None, None)
            continue
        assert r.sd == pytest.approx(sd, abs=1e-9)
        assert r.range_1_high == pytest.approx(mean + sd, abs=1e-9)
        assert r.range_1_low == pytest.approx(mean - sd, abs=1e-9)
        assert r.range_2_high == pytest.approx(mean + 2 * sd, abs=1e-9)
        assert r.range_2_low == pytest.approx(mean - 2 * sd, abs=1e-9)


figure = st.one_of(st.none(), st.integers(0, 50).map(float))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.sampled_from(["Large", "Small", None]), figure, figure, figure, figure),
    min_size=1, max_size=12,
))
def test_calibration_against_plain_python(spark, data):
    data = [(i, *row) for i, row in enumerate(data)]
    df = spark.createDataFrame(data, SCHEMA)
    expected = _expected(data)
    _check(B.calibrate_bands(df, ["N"], ["S"]), expected)
    panel = source_panel(df, ["area", "SIZE_CLASS"], ["N", "S"])
    _check(B.calibrate_long(panel, ["N"]), expected)


DATA = [
    (1, "Large", 10.0, 11.0, 0.5, 0.6), (2, "Large", 10.0, 9.0, 0.5, 0.4),
    (3, "Large", 10.0, 30.0, 0.5, 0.5), (4, "Small", 0.0, 5.0, 0.1, 0.2),
    (5, "Small", 10.0, 10.0, None, 0.2), (6, None, 10.0, 10.0, 0.1, 0.1),
]


@pytest.fixture
def bands(spark):
    ranges = {
        ("N", "Large"): (0.5, -0.5, 1.0, -1.0), ("N", "Small"): (0.1, -0.1, 0.2, -0.2),
        ("S", "Large"): (0.05, -0.05, 0.2, -0.2), ("N", None): (0.1, -0.1, 0.2, -0.2),
        ("N", "Huge"): (0.1, -0.1, 0.2, -0.2), ("other", "Large"): (0.1, -0.1, 0.2, -0.2),
    }
    return spark.createDataFrame(
        [(v, s, *r) for (v, s), r in ranges.items()],
        "variable string, SIZE_CLASS string, range_1_high double, range_1_low double, "
        "range_2_high double, range_2_low double",
    )


LABELS = {
    1: (CLOSE, SLIGHT), 2: (CLOSE, SLIGHT), 3: (HIGH, CLOSE), 4: (None, None),
    5: (CLOSE, None), 6: (CLOSE, None),  # bands without a class grade areas without one
}


def test_scores_wide_and_long_agree(spark, bands):
    df = spark.createDataFrame(DATA, SCHEMA)
    wide = B.score_wide(df, bands, ["N"], ["S"], {"N": "N_MEASURE"})
    assert wide.columns == [*df.columns, "N_MEASURE", "S_MEASURE"]
    assert {r.area: (r.N_MEASURE, r.S_MEASURE) for r in wide.collect()} == LABELS
    panel = source_panel(df, ["area", "SIZE_CLASS"], ["N", "S"])
    long = B.score_long(panel, bands, ["N"], ["S"]).collect()
    got = {}
    for r in long:
        got.setdefault(r.area, {})[r["variable"]] = r.divergence_measure
    assert {a: (g["N"], g["S"]) for a, g in got.items()} == LABELS


def test_compat_scores_an_estimate_of_zero(spark, bands):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = B.score_wide(df, bands, ["N"], ["S"], compat=True)
    # 5 / (5 + 0 / 2) = 1, beyond two sd.
    assert {r.area: r.N_MEASURE for r in out.collect()}[4] == HIGH


def test_repeated_bands_are_rejected(spark, bands):
    df = spark.createDataFrame(DATA, SCHEMA)
    with pytest.raises(PySparkException, match="more than one row"):
        B.score_wide(df, bands.union(bands), ["N"], ["S"]).collect()


def test_any_size_class_is_graded(spark, bands):
    df = spark.createDataFrame([(1, "Huge", 10.0, 11.5, 0.1, 0.1)], SCHEMA)
    [wide] = B.score_wide(df, bands, ["N"], ["S"], {"N": "N_MEASURE"}).collect()
    panel = source_panel(df, ["area", "SIZE_CLASS"], ["N"])
    [long] = B.score_long(panel, bands, ["N"], ["S"]).collect()
    assert wide.N_MEASURE == long.divergence_measure == SLIGHT


def test_unmatched_bands(spark, bands, rows):
    df = spark.createDataFrame(DATA, SCHEMA).filter("SIZE_CLASS = 'Small'")
    assert rows(B.unmatched_bands(bands, df)) == [("Huge",), ("Large",), (None,)]


def test_bands_are_mean_and_deviations(spark):
    df = spark.createDataFrame([(i, "Large", 10.0, 10.0 + i, 0.0, 0.0) for i in range(5)], SCHEMA)
    band = {r.variable: r for r in B.calibrate_bands(df, ["N"], []).collect()}["N"]
    # Relative differences 0, 0.1, .. 0.4: mean 0.2, sample sd sqrt(0.025).
    sd = math.sqrt(0.025)
    assert band["count"] == 5
    for got, wanted in [(band.mean, 0.2), (band.sd, sd), (band.range_1_high, 0.2 + sd),
                        (band.range_1_low, 0.2 - sd), (band.range_2_high, 0.2 + 2 * sd),
                        (band.range_2_low, 0.2 - 2 * sd)]:
        assert math.isclose(got, wanted, rel_tol=1e-9)
