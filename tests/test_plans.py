"""The published tables end to end on six areas, with both settings of every quirk.

01001 is large, 02063 and 02066 roll up into 02261, 51515 merges into 51019, and
72001 is outside the covered states.
"""

from __future__ import annotations

import datetime as dt

import pytest

from geopanel import constants as K
from geopanel import plans
from geopanel.operators.categories import code_list
from geopanel.plans.estimates import survey_by_name
from geopanel.sources import schemas as S

AREAS = {
    "01001": ("Alabama", "Autauga County"), "02063": ("Alaska", "Chugach Census Area"),
    "02066": ("Alaska", "Copper River Census Area"), "51019": ("Virginia", "Bedford County"),
    "11001": ("District of Columbia", "District of Columbia"),
}


def frame(spark, rows, contract, **defaults):
    data = [tuple({**defaults, **row}.get(c) for c in contract) for row in rows]
    return spark.createDataFrame(data, S.ddl(contract))


# --- County counts ------------------------------------------------------------


def _population(spark, areas):
    rows = []
    for geoid, scale in areas.items():
        for table in ("P2_", "P4_"):
            for item, code in enumerate(code_list(table, "N"), 1):
                value = scale * item if table == "P2_" else 1
                rows.append({"GEOID": geoid, "NAME": f"Area {geoid}", "variable": code,
                             "value": value})
    return frame(spark, rows, S.DECENNIAL_LONG)


def _housing(spark, areas):
    return frame(spark, [
        {"GEOID": geoid, "NAME": f"Area {geoid}", "variable": code, "value": scale * n}
        for geoid, scale in areas.items() for n, code in enumerate(K.HOUSING_CODES, 1)
    ], S.DECENNIAL_LONG)


def _codes(spark):
    return frame(spark, [
        {"state_code": "01", "county_code": "001", "state": "AL", "county": "Autauga County"},
        {"state_code": "02", "county_code": "063", "state": "AK", "county": "Chugach Census Area"},
    ], S.AREA_CODES)


def test_county_pl(spark):
    out = plans.county_pl(
        _population(spark, {"01001": 10, "72001": 10}),
        _housing(spark, {"01001": 2, "02063": 1, "72001": 1}), _codes(spark),
    )
    assert out.columns == list(S.COUNTY_PL)
    assert [f.dataType.simpleString() for f in out.schema] == list(S.COUNTY_PL.values())
    got = {r.fips: r for r in out.collect()}
    assert set(got) == {"01001", "02063"}
    r = got["01001"]
    # Item n has the value 10n; sor alone is 100: 60, 25, 1, 11, 1, 3 = 101, so white loses 1.
    assert (r.stabbrev, r.countynm) == ("AL", "Autauga County")
    assert (r.total_all_all, r.all_hisp_all) == (10, 20)
    assert r.white_all_all == 50 + 170 + 60 - 1
    assert r.black_all_all == 60 + 210 + 25
    assert r.aian_all_all == 70 + 240 + 1
    assert r.asian_all_all == 80 + 260 + 11
    assert r.nhpi_all_all == 90 + 270 + 1
    multi = 10 * sum(K.CATEGORY_ITEMS["multi_race"])
    assert r.twoplus_all_all == multi + 3
    assert (r.hu_total, r.gq_noninst_other) == (2, 26)
    only_housing = got["02063"]
    assert (only_housing.white_all_all, only_housing.hu_vacant) == (None, 3)


# --- Estimates ----------------------------------------------------------------


def _people(population, **extra):
    """A characteristics row: the population split over groups and sexes."""
    counts = {f"{g}_{s}": population // 20 for g in K.GROUP_SOURCES.values()
              for s in ("MALE", "FEMALE")}
    return {"YEAR": 13, "AGEGRP": 0, "TOT_POP": population, **counts, **extra}


def _estimate_inputs(spark):
    people, housing, components = [], [], []
    sizes = {"01001": 200_000, "02063": 7_000, "02066": 2_600, "51019": 60_000, "11001": 50_000}
    for geoid, n in sizes.items():
        state, county = AREAS[geoid]
        key = {"SUMLEV": "050", "STATE": geoid[:2], "COUNTY": geoid[2:]}
        named = {**key, "STNAME": state, "CTYNAME": county}
        people += [
            _people(n, **named), _people(n + 1, **{**named, "YEAR": 12}),
            _people(n + 2, **{**named, "AGEGRP": 1}),
            _people(n + 3, **{**named, "SUMLEV": "040"}),
        ]
        housing.append({**key, "HUESTIMATE042020": n // 2})
        components.append({**key, "GQESTIMATES2019": 100, "GQESTIMATES2020": 112})
    components[3]["GQESTIMATES2019"] = components[3]["GQESTIMATES2020"] = 0  # 51019
    housing.pop()  # no housing estimate for 11001
    survey = [
        {"GEOID": g, "variable": code, "estimate": value, "moe": 1.0}
        for g in ("01001", "02261", "51019") for code, value in
        (("B28002_004", 60.0), ("B28002_001", 80.0))
    ]
    national = [{"GEOID": "1", "variable": "B28002_004", "estimate": 85.0},
                {"GEOID": "1", "variable": "B28002_001", "estimate": 100.0}]
    return (
        frame(spark, people, S.CHARACTERISTICS_2020), frame(spark, housing, S.HOUSING_2020),
        frame(spark, components, S.COMPONENTS_2020),
        survey_by_name(frame(spark, survey, S.SURVEY_LONG)),
        survey_by_name(frame(spark, national, S.SURVEY_LONG)),
    )


def test_estimates(spark):
    out = plans.estimates(*_estimate_inputs(spark))
    assert out.columns == list(S.ESTIMATES)
    assert [f.dataType.simpleString() for f in out.schema] == list(S.ESTIMATES.values())
    got = {r.GEOID: r for r in out.collect()}
    assert set(got) == {*AREAS, "02261"}
    assert out.count() == 6
    a = got["01001"]
    assert (a.EST_POP_TOT, a.EST_NH_WA_TOT, a.EST_HU_TOT) == (200_000, 20_000, 100_000)
    assert (a.EST_GQ_TOT, a.GEOYEAR) == (109, 2020)
    assert (a.PCT_HH_BROADBAND, a.PCT_HH_BROADBAND_NATIONAL) == (75.0, 85.0)
    parent = got["02261"]
    assert (parent.EST_POP_TOT, parent.EST_HU_TOT, parent.EST_GQ_TOT) == (9_600, 4_800, 218)
    assert (parent.GEOYEAR, parent.STNAME) == (2019, "Alaska")
    assert parent.CTYNAME == "Valdez-Cordova Census Area"
    # The older area's rate is handed to the areas it was split into.
    assert [got[k].PCT_HH_BROADBAND for k in ("02063", "02066", "02261")] == [75.0] * 3
    assert got["11001"].EST_HU_TOT is None
    assert got["11001"].PCT_HH_BROADBAND_NATIONAL is None


@pytest.mark.parametrize("options", [{"compat": True}, {"parent_names": {}}])
def test_parent_named_after_its_first_member(spark, options):
    out = plans.estimates(*_estimate_inputs(spark), **options).filter("GEOID = '02261'")
    assert out.collect()[0].CTYNAME == "Chugach Census Area"


# --- Main table ---------------------------------------------------------------


def _counts(spark):
    sizes = {"01001": 210_000, "02063": 7_100, "02066": 2_600, "51019": 60_000, "11001": 50_000}
    rows = []
    for geoid, n in sizes.items():
        groups = {c: n // 10 for c in S.COUNTY_PL if c.endswith("_all_all")}
        rows.append({"fips": geoid, **groups, "all_hisp_all": n // 10, "total_all_all": n,
                     "hu_total": n // 2, "hu_vacant": n // 20, "gq_total": 109})
    return frame(spark, rows, S.COUNTY_PL)


def _bands(spark, sizes=("Large", "Medium", "Small")):
    rows = [
        {"variable": m, "SIZE_CLASS": size, "count": 5, "mean": 0.0, "sd": 0.02,
         "range_1_high": 0.02, "range_1_low": -0.02, "range_2_high": 0.04, "range_2_low": -0.04}
        for m in K.MEASURE_NAMES for size in sizes
    ]
    return frame(spark, rows, S.CUTPOINTS)


def _vacant_2010(spark):
    units = {"01001": (100_000, 3_000), "02261": (6_000, 600), "51515": (2_000, 100),
             "51019": (28_000, 2_900), "72001": (10, 1), "46113": (100, 10)}
    return frame(spark, [
        {"GEOID": g, "NAME": g, "variable": code, "value": v}
        for g, pair in units.items() for code, v in zip(K.VACANCY_CODES_2010, pair)
    ], S.DECENNIAL_LONG)


def _main(spark, bands=None, **options):
    est = plans.estimates(*_estimate_inputs(spark))
    return plans.county_main(
        _counts(spark), est, bands or _bands(spark), _vacant_2010(spark), **options
    )


def test_main_table(spark):
    out = _main(spark)
    assert out.columns == K.COUNTY_MAIN_COLUMNS
    assert len(out.columns) == 70
    rows = out.collect()
    got = {r.GEOID: r for r in rows}
    # 46102 is only known from the 2010 count, under its code of today.
    assert sorted(got) == sorted([*AREAS, "02261", "46102"]) and len(rows) == 7

    a = got["01001"]
    assert (a.SIZE_CLASS, a.STNAME, a.GEOYEAR, a.NOTES) == ("Large", "Alabama", 2020, "")
    assert (a.POP_DIFF, a.SHARE_POP_DIFF) == (10_000, 0.05)
    assert a.POP_MEASURE == K.HIGH  # 5 % against two sd of 4 %
    assert (a.GQ_DIFF, a.SHARE_GQ_DIFF, a.GQ_MEASURE) == (0, 0.0, K.CLOSE)
    assert a.CEN_HH_TOT == 210_000 - 109
    assert a.CEN_PPH_TOT == pytest.approx((210_000 - 109) / 105_000)
    assert (a.PCT_VACANT_HU_2020, a.PCT_VACANT_HU_2010) == (10.0, 3.0)
    assert (a.PCT_VACANT_CHANGE, a.VACANCY_MEASURE) == (7.0, K.HIGH)

    parent = got["02261"]
    assert (parent.CEN_POP_TOT, parent.EST_POP_TOT, parent.SIZE_CLASS) == (9_700, 9_600, "Small")
    assert parent.NOTES == K.AREA_NOTES["02261"]
    assert parent.POP_MEASURE == K.CLOSE
    assert (parent.PCT_VACANT_HU_2010, parent.VACANCY_MEASURE) == (10.0, K.CLOSE)
    # The split areas take the 2010 rate of the area they came from.
    assert got["02063"].PCT_VACANT_HU_2010 == got["02066"].PCT_VACANT_HU_2010 == 10.0

    merged = got["51019"]
    assert merged.PCT_VACANT_HU_2010 == 10.0  # (100 + 2900) / (2000 + 28000)
    # An estimate of 0 has no relative difference: no share and no grade.
    assert (merged.EST_GQ_TOT, merged.GQ_DIFF) == (0, 109)
    assert (merged.SHARE_GQ_DIFF, merged.GQ_MEASURE) == (None, None)

    dc = got["11001"]
    assert (dc.STNAME, dc.CTYNAME, dc.SIZE_CLASS) == (
        "District of Columbia", "Washington", "Medium"
    )
    assert (dc.HU_DIFF, dc.SHARE_HU_DIFF, dc.HU_MEASURE, dc.PPH_MEASURE) == (None,) * 4
    assert (dc.PCT_VACANT_HU_2010, dc.VACANCY_MEASURE) == (None, None)

    unknown = got["46102"]
    assert (unknown.PCT_VACANT_HU_2010, unknown.CEN_POP_TOT, unknown.NOTES) == (10.0, None, None)


def test_main_table_compat(spark):
    got = {r.GEOID: r for r in _main(spark, compat=True).collect()}
    merged = got["51019"]
    assert merged.SHARE_GQ_DIFF == float("inf")
    assert merged.GQ_MEASURE == K.HIGH  # 109 / (109 + 0 / 2)
    # 10000 / (210000 + 100000) is 3.2 %, within two sd.
    assert got["01001"].POP_MEASURE == K.SLIGHT
    assert got["02063"].PCT_VACANT_HU_2010 is None
    assert got["02261"].PCT_VACANT_HU_2010 == 10.0


def test_compat_keeps_bands_without_areas(spark):
    bands = _bands(spark, ("Large", "Medium", "Small", "Huge"))
    extra = [r for r in _main(spark, bands, compat=True).collect() if r.GEOID is None]
    assert [(r.SIZE_CLASS, r.POP_MEASURE) for r in extra] == [("Huge", None)]
    assert all(r.GEOID for r in _main(spark, bands).collect())


# --- Calibration --------------------------------------------------------------


def _cutpoint_inputs(spark):
    sizes = {"01001": 120_000, "01003": 110_000, "02063": 9_000, "51515": 6_000}
    older, newer, housing, components, quarters, counted = ([] for _ in range(6))
    for i, (geoid, n) in enumerate(sizes.items()):
        names = {"STNAME": f"S{geoid[:2]}", "CTYNAME": f"C{geoid}"}
        older.append(_people(n, **names, STATE=int(geoid[:2]), COUNTY=int(geoid[2:])))
        newer.append(_people(n + 1_200 * i, **names, STATE=geoid[:2], COUNTY=geoid[2:], YEAR=1))
        key = {"state": geoid[:2], "county": geoid[2:]}
        housing.append({"sumlev": "050", **key, "huest_042010": n // 2})
        components.append({"SUMLEV": "050", "STATE": geoid[:2], "COUNTY": geoid[2:],
                           "GQESTIMATES2009": 100, "GQESTIMATES2010": 100})
        quarters.append({"GEOID": geoid, "variable": "P042001", "value": 100 + 10 * i})
        counted += [{"GEOID": geoid, "variable": "H001001", "value": n // 2},
                    {"GEOID": geoid, "variable": "H001003", "value": 5}]
    # An area only in the housing file, and one of the excluded state.
    housing.append({"sumlev": "050", "state": "99", "county": "001", "huest_042010": 7})
    quarters.append({"GEOID": "72001", "variable": "P042001", "value": 1})
    return (
        frame(spark, older, S.CHARACTERISTICS_2010), frame(spark, housing, S.HOUSING_2010),
        frame(spark, components, S.COMPONENTS_2010), frame(spark, newer, S.CHARACTERISTICS_2012),
        frame(spark, quarters, S.DECENNIAL_LONG), frame(spark, counted, S.DECENNIAL_LONG),
    )


def test_cutpoints(spark):
    out = plans.cutpoints(*_cutpoint_inputs(spark))
    assert out.columns == K.CUTPOINT_COLUMNS
    got = {(r.variable, r.SIZE_CLASS): r for r in out.collect()}
    # Two classes occur, and the area without a count has none: 11 variables each.
    assert {s for _, s in got} == {"Large", "Small", None}
    assert {v for v, _ in got} == set(K.MEASURE_NAMES)
    large = got["GQ_TOT", "Large"]
    assert (large["count"], large["mean"]) == (2, pytest.approx(0.05))
    assert large.sd == pytest.approx(0.1 / 2 ** 0.5)
    assert large.range_2_high == pytest.approx(0.05 + 2 * large.sd)
    small = got["POP_TOT", "Small"]
    assert small["mean"] == pytest.approx((2_400 / 9_000 + 3_600 / 6_000) / 2)
    alone = got["HU_TOT", None]
    assert (alone["count"], alone["mean"], alone.sd) == (1, 0.0, None)


def test_vacancy_2010(spark, rows):
    long = _vacant_2010(spark).replace(
        dict(zip(K.VACANCY_CODES_2010, K.HOUSING_CODES_2010)), subset=["variable"]
    )
    out = plans.vacancy_2010(long)
    assert out.columns == ["GEOID", "cen2010_pct_vacant_hu"]
    assert rows(out) == [("01001", 3.0), ("02063", 10.0), ("02066", 10.0), ("02261", 10.0),
                         ("46102", 10.0), ("51019", 10.0)]


# --- Context ------------------------------------------------------------------

SUNDAYS = [dt.date(2020, 1, 5), dt.date(2020, 1, 12)]


def _covid(spark, compat):
    national = frame(spark, [
        {"date": d, "geoid": "USA", "cases_avg_per_100k": v} for d, v in
        [(SUNDAYS[0], 1.0), (SUNDAYS[1], 2.0), (dt.date(2020, 1, 6), 9.0),
         (dt.date(2021, 1, 3), 9.0), (dt.date(2019, 12, 29), 9.0)]
    ], S.DAILY_CASES)
    county = frame(spark, [
        {"date": d, "geoid": g, "cases_avg_per_100k": v} for d, g, v in
        [(SUNDAYS[0], "USA-02063", 3.0), (SUNDAYS[0], "USA-02066", 4.0),
         (SUNDAYS[1], "USA-02063", 5.0), (SUNDAYS[1], "USA-99999", 7.0)]
    ], S.COUNTY_DAILY_CASES)
    areas = frame(spark, [{"fips": f} for f in ("1001", "02063", "02066")], S.COUNTY_PL)
    return plans.covid_weekly(areas, national, county, compat=compat)


@pytest.mark.parametrize("compat, doubled", [(False, (1.0, 2.0)), (True, (2.0, 4.0))])
def test_covid_weekly(spark, rows, compat, doubled):
    out = _covid(spark, compat)
    assert out.columns == [
        "geoid", "date", "national_cases_avg_per_100k", "county_cases_avg_per_100k"
    ]
    assert rows(out) == sorted([
        ("01001", SUNDAYS[0], 1.0, None), ("01001", SUNDAYS[1], 2.0, None),
        ("02063", SUNDAYS[0], 1.0, 3.0), ("02063", SUNDAYS[1], 2.0, 5.0),
        ("02066", SUNDAYS[0], 1.0, 4.0), ("02066", SUNDAYS[1], 2.0, None),
        ("02261", SUNDAYS[0], doubled[0], 7.0), ("02261", SUNDAYS[1], doubled[1], None),
    ], key=lambda t: tuple((v is None, str(v)) for v in t))


def _rates(spark, data):
    return spark.createDataFrame(data, "state string, county string, rate string, pop bigint")


def test_response_rates(spark, rows):
    county = [
        (_rates(spark, [("02", "063", "30.0", 3), ("02", "066", "60.0", 1), ("1", "001", "x", 1)]),
         2020),
        (_rates(spark, [("02", "063", "40.0", 1)]), 2010),
    ]
    national = [(spark.createDataFrame([("67.0",)], "rate string"), 2020),
                (spark.createDataFrame([("66.5",)], "rate string"), 2010),
                (spark.createDataFrame([("65.0",)], "rate string"), 2000)]
    out = plans.response_rates(county, national)
    assert out.columns == ["GEOID", "year", "county-response-rate", "us-response-rate"]
    assert rows(out) == [
        ("01001", 2020, None, 67.0),  # state and county are joined, then padded
        ("02063", 2010, 40.0, 66.5), ("02063", 2020, 30.0, 67.0), ("02066", 2020, 60.0, 67.0),
        ("02261", 2010, 40.0, 66.5), ("02261", 2020, 45.0, 67.0), (None, 2000, None, 65.0),
    ]
    weighted = plans.response_rates(county, national, weight="pop")
    parent = {r.year: r["county-response-rate"] for r in
              weighted.filter("GEOID = '02261'").collect()}
    assert parent == {2010: 40.0, 2020: 37.5}


@pytest.mark.parametrize("compat, key", [(False, "01001"), (True, "010010")])
def test_unemployment(spark, rows, compat, key):
    series = frame(spark, [
        {"series_id": "LAUCN010010000000003", "year": 2020, "period": p, "value": v}
        for p, v in (("M01", 3.1), ("M02", 3.2), ("M13", 9.9))
    ], S.LABOUR_SERIES)
    national = frame(spark, [{"month": "01/01/20", "national_unemployment_rate": 4.0}],
                     S.MONTHLY_RATE)
    out = plans.unemployment(series, national, compat=compat)
    assert rows(out) == [(key, "01/01/20", 3.1, 4.0), (key, "02/01/20", 3.2, None)]


def test_disasters(spark):
    out = plans.disasters(frame(spark, [
        {"GEOID": "01001", "declarationTitle": "SEVERE STORMS, STRAIGHT-LINE WINDS"}
    ], {**S.DISASTERS, "other": "string"}))
    assert out.columns == K.FEMA_COLUMNS
    assert out.collect()[0].declarationTitle == "Severe Storms, Straight-Line Winds"
