"""Files in, files out: the tables chained through the command line."""

from __future__ import annotations

import pytest

from geopanel import constants as K
from geopanel import run
from geopanel.sources import schemas as S
from geopanel.sources.delimited import read_csv, write_csv
from tests import test_plans as fixtures


@pytest.fixture
def folder(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    for name, frame in {
        "population": fixtures._population(spark, {"01001": 10, "02063": 3, "02066": 4}),
        "housing": fixtures._housing(spark, {"01001": 2, "02063": 1, "02066": 1}),
        "codes": fixtures._codes(spark), "bands": fixtures._bands(spark),
        "vacant": fixtures._vacant_2010(spark),
    }.items():
        write_csv(frame, path(name))
    return path


def test_main_table_from_files(spark, folder):
    run.main(["county_pl", "--population", folder("population"), "--housing", folder("housing"),
              "--codes", folder("codes"), "--out", folder("counts.parquet"),
              "--format", "parquet"], spark)
    frames = fixtures._estimate_inputs(spark)
    for name, frame in zip(("chars", "units", "gq"), frames):
        write_csv(frame, folder(name))
    back = {v: k for k, v in K.BROADBAND_CODES.items()}
    for name, frame in zip(("county", "us"), frames[3:]):
        write_csv(frame.replace(back, subset=["variable"]), folder(name))
    run.main(["estimates", "--characteristics", folder("chars"), "--housing", folder("units"),
              "--components", folder("gq"), "--survey-county", folder("county"),
              "--survey-national", folder("us"), "--out", folder("estimates")], spark)
    arguments = ["county_main", "--counts", folder("counts.parquet"), "--estimates",
                 folder("estimates"), "--bands", folder("bands"), "--housing-2010-long",
                 folder("vacant")]
    run.main([*arguments, "--out", folder("main")], spark)
    run.main([*arguments, "--out", folder("quirks"), "--compat"], spark)
    types = {c: "double" for c in K.COUNTY_MAIN_COLUMNS}
    texts = ["GEOID", "STNAME", "CTYNAME", "SIZE_CLASS", "NOTES", *K.MEASURE_NAMES.values(),
             "VACANCY_MEASURE"]
    types |= {c: "string" for c in texts}
    main = {r.GEOID: r for r in read_csv(spark, folder("main"), types).collect()}
    assert {"01001", "02063", "02066", "02261"} <= set(main)
    assert main["02261"].CEN_POP_TOT == 7
    assert main["02261"].EST_POP_TOT == 9_600
    assert main["01001"].POP_MEASURE == K.HIGH
    assert main["02063"].PCT_VACANT_HU_2010 == 10.0
    quirks = {r.GEOID: r for r in read_csv(spark, folder("quirks"), types).collect()}
    assert quirks["02063"].PCT_VACANT_HU_2010 is None


def test_response_rates_from_files(spark, tmp_path, rows):
    paths = {}
    for key, (column, local) in run.TABLES["response_rates"].inputs.items():
        names = [column, *(["state", "county"] if local else [])]
        row = ["70.5", *(["01", "001"] if local else [])]
        text = "[[" + ",".join(f'"{n}"' for n in names) + "],\n[" + \
            ",".join(f'"{v}"' for v in row) + "]]"
        (tmp_path / f"{key}.json").write_text(text)
        paths[key] = str(tmp_path / f"{key}.json")
    out = run.build(spark, "response_rates", paths)
    assert rows(out) == [("01001", 2010, 70.5, 70.5), ("01001", 2020, 70.5, 70.5)]


def test_every_table_has_a_command():
    names = {a for a in run.parser()._subparsers._group_actions[0].choices}
    from geopanel import plans
    assert names == set(plans.__all__)


def test_unemployment_from_files(spark, tmp_path, rows):
    (tmp_path / "s.txt").write_text(
        "series_id\tyear\tperiod\tvalue\tfootnote_codes\n"
        "LAUCN010010000000003 \t2020\tM01\t   3.1\t\n"
    )
    (tmp_path / "n.csv").write_text("month,national_unemployment_rate\n01/01/20,4\n")
    out = run.build(spark, "unemployment",
                    {"series": str(tmp_path / "s.txt"), "national": str(tmp_path / "n.csv")})
    assert rows(out) == [("01001", "01/01/20", 3.1, 4.0)]
    assert S.MONTHLY_RATE["national_unemployment_rate"] == "double"
