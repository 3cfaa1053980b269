from __future__ import annotations

import datetime as dt
import os

import pytest

from geopanel.functions import as_number
from geopanel.session import shared_folder
from geopanel.sources import schemas
from geopanel.sources.coded import read_decennial, read_survey, select_codes
from geopanel.sources.delimited import read_csv, read_tsv, write_csv
from geopanel.sources.header_json import parse_rows, read_header_json


def _write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_csv_reads_by_name_and_keeps_leading_zeros(spark, tmp_path, rows):
    path = _write(tmp_path / "a.csv", "extra,COUNTY,STATE,n,x\n1,001,01,5,NA\n2,003,,NA,Inf\n3,,01,,NaN\n")
    contract = {"STATE": "string", "COUNTY": "string", "n": "bigint", "x": "double"}
    assert rows(read_csv(spark, path, contract)) == [
        ("01", "001", 5, None), ("01", None, None, None), (None, "003", None, float("inf")),
    ]


@pytest.mark.parametrize("read, sep", [(read_csv, ","), (read_tsv, "\t")])
def test_files_of_a_folder_must_agree_on_their_header(spark, tmp_path, rows, read, sep):
    for name, text in (("1", "a,b\n1,2\n"), ("2", "a,b\n3,4\n")):
        _write(tmp_path / f"{name}.csv", text.replace(",", sep))
    contract = {"b": "bigint", "a": "bigint"}
    assert rows(read(spark, str(tmp_path), contract)) == [(2, 1), (4, 3)]
    _write(tmp_path / "3.csv", "b,a\n2,1\n".replace(",", sep))
    with pytest.raises(Exception, match="header|schema"):
        read(spark, str(tmp_path), contract).collect()


@pytest.mark.parametrize("line", ["x7,1,2", "1,2", "1,2,3,4"])
def test_malformed_fields_and_rows(spark, tmp_path, rows, line):
    path = _write(tmp_path / "a.csv", f"n,a,b\n5,6,7\n{line}\n")
    contract = {"n": "bigint", "a": "bigint"}
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, contract).collect()
    kept = rows(read_csv(spark, path, contract, malformed="null"))
    assert (5, 6) in kept and len(kept) == 2


def test_csv_missing_column(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="missing columns"):
        read_csv(spark, path, {"c": "int"})


def test_csv_encoding_and_quotes(spark, tmp_path, rows):
    path = _write(tmp_path / "a.csv", 'n,t\n1,"Doña Ana, ""NM"""\n', "latin-1")
    out = read_csv(spark, path, {"n": "int", "t": "string"}, encoding="ISO-8859-1")
    assert rows(out) == [(1, 'Doña Ana, "NM"')]


def test_quoted_newlines(spark, tmp_path, rows):
    path = _write(tmp_path / "a.csv", 'n,t\n1,"two\nlines"\n')
    out = read_csv(spark, path, {"n": "int", "t": "string"}, quoted_newlines=True)
    assert rows(out) == [(1, "two\nlines")]


def test_tsv_is_trimmed(spark, tmp_path, rows):
    path = _write(
        tmp_path / "a.txt",
        "series_id                     \tyear\tperiod\t       value\tfootnote_codes\n"
        "LAUCN010010000000003          \t2020\tM01\t         3.1\t\n",
    )
    out = read_tsv(spark, path, schemas.LABOUR_SERIES)
    assert rows(out) == [("LAUCN010010000000003", 2020, "M01", 3.1)]


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame(
        [("02063", None, float("inf"), "", dt.date(2020, 1, 5)),
         ("01001", 3, -float("inf"), 'a "b", c', None)],
        "GEOID string, n bigint, x double, t string, d date",
    )
    path = str(tmp_path / "out")
    write_csv(df.coalesce(1).sortWithinPartitions("GEOID"), path)
    [part] = [f for f in os.listdir(path) if f.startswith("part-")]
    lines = open(os.path.join(path, part), encoding="utf-8").read().splitlines()
    assert lines == [
        "GEOID,n,x,t,d", '01001,3,-Inf,"a ""b"", c",NA', "02063,NA,Inf,,2020-01-05",
    ]
    with pytest.raises(Exception, match="already exists"):
        write_csv(df, path)


def test_sink_and_source_agree(spark, rows):
    contract = schemas.CUTPOINTS
    df = spark.createDataFrame(
        [("GQ_TOT", "Large", 578, -0.0274, 0.1987, 0.1712, -0.2261, 0.3699, -0.4248),
         ("GQ_TOT", None, 1, 0.5, None, None, None, None, None)],
        schemas.ddl(contract),
    )
    path = shared_folder(spark, "cutpoints")
    write_csv(df, path)
    assert rows(read_csv(spark, path, contract)) == rows(df)


LINES = '[["RATE","state","county"],\n["70.1","01","001"],\n[null,"02","063"],\n["x","02","066"]]\n'
FIELDS = {"county": "county", "state": "state", "rate": "RATE"}
PARSED = [("001", "01", 70.1), ("063", "02", None), ("066", "02", None)]


@pytest.mark.parametrize("layout, text", [
    ("rows", LINES), ("rows", LINES.replace("\n", "")), ("rows", LINES.replace(',"', ' , "')),
    ("documents", LINES), ("documents", LINES.replace(",", " , ")),
])
def test_header_json(spark, tmp_path, rows, layout, text):
    path = _write(tmp_path / "r.json", text)
    out = read_header_json(spark, path, FIELDS, layout)
    assert rows(out.withColumn("rate", as_number("rate"))) == PARSED


def test_header_json_columns_in_another_order(spark, tmp_path, rows):
    path = _write(tmp_path / "r.json", '[["state","county","RATE"],\n["01","001","70.1"]]')
    assert rows(read_header_json(spark, path, FIELDS)) == [("001", "01", "70.1")]
    named = read_header_json(spark, path, FIELDS, header=["state", "county", "RATE"])
    assert rows(named) == [("001", "01", "70.1")]


@pytest.mark.parametrize("text, message", [
    ('[["a","state","county"],\n["1","01","001"]]', "not in the header: RATE"),
    ('[["RATE","state","county"],\n["1","01"]]', "length|size|same"),
    ('[["RATE","state","county"],\nbroken]', "not a single row|whole array"),
    ('[["RATE","state","county"],\n["a],b","01","001"]]', "not a single row"),
])
def test_header_json_fails_loudly(spark, tmp_path, text, message):
    path = _write(tmp_path / "r.json", text)
    with pytest.raises(Exception, match=message):
        read_header_json(spark, path, FIELDS).collect()


@pytest.mark.parametrize("text", [
    '[["RATE","state","county"],["1","01","001"],',
    '[["RATE","state","county"],["1","01","001"],["2","01","002"',
    '[["RATE","state","county"],["1","01","001"]',
    '["RATE","state","county"],["1","01","001"]]',
])
def test_files_that_are_not_whole_fail(spark, tmp_path, text):
    folder = tmp_path / "files"
    folder.mkdir()
    _write(folder / "good.json", '[["RATE","state","county"],["9","02","001"]]')
    _write(folder / "bad.json", text)
    for layout in ("rows", "documents"):
        with pytest.raises(Exception, match="whole array|not an array|not a single row"):
            read_header_json(spark, str(folder), FIELDS, layout).collect()


@pytest.mark.parametrize("text", [
    "garbage", '{"error": "no"}', "[]", "", "[[]", '[["RATE","state","county"],["1","01","001"]] x',
])
def test_documents_are_never_lost(spark, rows, text):
    from geopanel.sources.header_json import parse_documents

    good = '[["RATE","state","county"],["1","01","001"]]'
    frame = spark.createDataFrame([(good,), (text,)], "value string")
    with pytest.raises(Exception, match="not an array of arrays|not in the header"):
        parse_documents(frame, FIELDS).collect()


def test_documents_take_any_valid_layout(spark, tmp_path, rows):
    path = _write(tmp_path / "r.json", '[["RATE","state","county"] ,\n["1","a],b","[x"]\n]\n')
    assert rows(read_header_json(spark, path, FIELDS, "documents")) == [("[x", "a],b", "1")]


def test_header_json_with_blanks_between_rows_fails(spark, tmp_path):
    path = _write(tmp_path / "r.json", LINES.replace("],", "] ,"))
    with pytest.raises(Exception, match="not a single row"):
        read_header_json(spark, path, FIELDS).collect()


def test_header_json_keeps_brackets_in_values(spark, tmp_path, rows):
    path = _write(tmp_path / "r.json", '[["RATE","state","county"],["a[1]","[x]","q\\"]z"]]')
    assert rows(read_header_json(spark, path, FIELDS)) == [('q"]z', "[x]", "a[1]")]


def test_header_json_splits_over_tasks(spark, tmp_path):
    rows = ",".join(f'["{i / 10}","{i % 50:02d}","{i:05d}"]' for i in range(20_000))
    path = _write(tmp_path / "r.json", f'[["RATE","state","county"],{rows}]')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        out = read_header_json(spark, path, FIELDS)
        assert spark.read.text(path, lineSep="],").rdd.getNumPartitions() > 5
        got = {(r.county, r.state, r.rate) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(f"{i:05d}", f"{i % 50:02d}", str(i / 10)) for i in range(20_000)}


def test_header_json_with_two_headers(spark):
    df = spark.createDataFrame([('[["RATE","state","county"],',), ('[["RATE","county","state"],',),
                                ('["1","2","3"]',)], "value string")
    with pytest.raises(Exception, match="More than one row"):
        parse_rows(df, FIELDS).collect()


def test_coded_tables(spark, tmp_path, rows):
    path = _write(tmp_path / "long.csv",
                  "GEOID,NAME,variable,value\n01001,A,P042001,5\n01001,A,P002001,9\n")
    assert rows(read_decennial(spark, path, ["P002001"])) == [("01001", "A", "P002001", 9)]
    assert rows(read_decennial(spark, path, {"P042001": "GQ_TOT"}), "variable", "value") == [
        ("GQ_TOT", 5)
    ]
    parquet = str(tmp_path / "long.parquet")
    read_decennial(spark, path, ["P002001", "P042001"]).write.parquet(parquet)
    assert read_decennial(spark, parquet, ["P042001"]).count() == 1
    survey = _write(tmp_path / "s.csv",
                    "GEOID,NAME,variable,estimate,moe\n01001,A,B28002_004,50,1\n")
    out = read_survey(spark, survey, {"B28002_004": "broadband"})
    assert rows(out, "variable", "estimate") == [("broadband", 50.0)]


def test_code_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "long.parquet")
    spark.createDataFrame([("01001", "A", "P042001", 5)], schemas.ddl(schemas.DECENNIAL_LONG)) \
        .write.parquet(path)
    out = select_codes(spark.read.parquet(path), {"P042001": "GQ_TOT"}).select("GEOID", "value")
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(variable,P042001)" in text or "In(variable, [P042001])" in text
    assert "ReadSchema: struct<GEOID:string,variable:string,value:bigint>" in text
