from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from geopanel.sources.delimited import read_csv
from geopanel.sources.header_json import read_header_json
from geopanel.sources.quoted import quoted_records

FIELDS = {"county": "county", "state": "state", "rate": "RATE"}
HEAD = '[["RATE","state","county"]'


@pytest.fixture
def blocks_of(spark):
    """Cut files into blocks of so many bytes for one test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_size
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def _write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def _rows(seed, n):
    draw = random.Random(seed)
    parts = ["a", "ü", ",", "\n", '"', "\n\n", "漢", " ", "x" * 40, "\r\n"]
    return [(i, "".join(draw.choices(parts, k=draw.randrange(12)))) for i in range(n)]


def _csv(rows, end="\n"):
    quoted = ("n,t" + end) + "".join(
        '{},"{}"{}'.format(n, t.replace('"', '""'), end) for n, t in rows)
    return quoted


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_split_over_blocks(spark, tmp_path, blocks_of, size, end):
    for seed in (1, 2):
        _write(tmp_path / f"{seed}.csv", _csv(_rows(seed, 60), end))
    contract = {"n": "int", "t": "string"}
    blocks_of(size)
    got = sorted((r.n, r.t or "") for r in read_csv(
        spark, str(tmp_path), contract, quoted_newlines=True).collect())
    assert got == sorted(_rows(1, 60) + _rows(2, 60))


def test_one_large_file_is_read_by_many_tasks_and_equals_the_reader_of_whole_files(
        spark, tmp_path, blocks_of, rows):
    path = _write(tmp_path / "a.csv", _csv([r for s in range(40) for r in _rows(s, 100)]))
    whole = spark.read.csv(path, header=True, multiLine=True, escape='"', nullValue="NA",
                           schema="n int, t string")
    blocks_of(8_000)
    out = read_csv(spark, path, {"n": "int", "t": "string"}, quoted_newlines=True)
    tasks = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4
    assert rows(out) == rows(whole)


@pytest.mark.parametrize("text, message", [
    ("n,t\n1,a,b\n", "(?i)malformed"), ("n,t\nx,a\n", "(?i)malformed")])
def test_malformed_rows_are_errors(spark, tmp_path, rows, text, message):
    path = _write(tmp_path / "a.csv", text)
    with pytest.raises(Exception, match=message):
        read_csv(spark, path, {"n": "int", "t": "string"}, quoted_newlines=True).collect()
    kept = read_csv(spark, path, {"n": "int", "t": "string"}, quoted_newlines=True,
                    malformed="null")
    assert kept.count() == 1


def test_another_header_is_an_error(spark, tmp_path):
    _write(tmp_path / "a.csv", 'n,t\n1,"x\ny"\n2,z\n')
    _write(tmp_path / "b.csv", 't,n\n"x",1\n')
    with pytest.raises(Exception, match="another header|missing columns"):
        read_csv(spark, str(tmp_path), {"n": "int", "t": "string"}, quoted_newlines=True).collect()


def _free(rows, seed):
    """Any valid layout: white space everywhere, brackets and quotes in values."""
    draw = random.Random(seed)

    def blank():
        return "".join(draw.choices([" ", "\n", "\t", ""], k=draw.randrange(3)))

    def array(values):
        return f"{blank()}[{blank()}" + f"{blank()},{blank()}".join(values) + f"{blank()}]{blank()}"

    lines = [array(json.dumps(v) for v in row) for row in rows]
    return f"{blank()}[{','.join(lines)}]{blank()}"


def _values(seed, n):
    draw = random.Random(seed)
    parts = ["]", "[", "],", '"', "\\", "a", "é", " ", "\n", "],["]
    return [["".join(draw.choices(parts, k=draw.randrange(6))) if j else f"{i}.5"
             for j in range(3)] for i in range(n)]


@pytest.mark.parametrize("size", [5, 100, 1 << 20])
def test_free_layout_splits_over_blocks(spark, tmp_path, blocks_of, size):
    rows = {seed: _values(seed, 40) for seed in (1, 2)}
    for seed, some in rows.items():
        _write(tmp_path / f"{seed}.json", _free([["RATE", "state", "county"], *some], seed))
    blocks_of(size)
    got = read_header_json(spark, str(tmp_path), FIELDS, "free").collect()
    assert sorted([r.rate, r.state, r.county] for r in got) == sorted(rows[1] + rows[2])


def test_free_layout_nulls_and_numbers(spark, tmp_path):
    path = _write(tmp_path / "r.json", HEAD + ' ,\n[null , "01", 7 ] , [ "x" ,"02", "8"]\n] \n')
    got = read_header_json(spark, path, FIELDS, "free").collect()
    assert [tuple(r) for r in got] == [("7", "01", None), ("8", "02", "x")]


@pytest.mark.parametrize("text", [
    HEAD + ',["1","01","001"],', HEAD + ',["1","01","001"],["2","01","002"',
    HEAD + ',["1","01","001"]', HEAD + ',["1","01","001"]\n', HEAD + '],["1","01","001"]',
    HEAD + ',["1","01","001"]]]', HEAD + '["1","01","001"]]', HEAD + ',["1","01"]]',
    HEAD + ',["1","01","001"]] x', HEAD + ',["1","01","00]]', '["RATE"]',
    HEAD + ',[["RATE","state","county"]]',
])
def test_free_layout_of_broken_files_fails(spark, tmp_path, text):
    _write(tmp_path / "bad.json", text)
    _write(tmp_path / "good.json", HEAD + ',["1","01","001"]]')
    with pytest.raises(Exception, match="whole array|single row|another length|not in the header"):
        read_header_json(spark, str(tmp_path), FIELDS, "free").collect()


@pytest.mark.parametrize("layout", ["rows", "free"])
def test_files_with_different_headers_fail(spark, tmp_path, layout):
    _write(tmp_path / "a.json", HEAD + ',["1","01","001"]]')
    _write(tmp_path / "b.json", '[["state","RATE","county"],["01","1","001"]]')
    with pytest.raises(Exception, match="another header"):
        read_header_json(spark, str(tmp_path), FIELDS, layout).collect()


def test_records_are_in_order_and_ends_are_told(spark, tmp_path, blocks_of):
    _write(tmp_path / "a", 'x;"y;z";;w')
    _write(tmp_path / "b", '"1;2;3;4;5;6;7;8;9";')
    blocks_of(4)
    records, files = quoted_records(spark, str(tmp_path), ";")
    got = {}
    for r in sorted(records.collect(), key=lambda r: tuple(r["at"])):
        got.setdefault(r.file[-1], []).append(r.value)
    assert got == {"a": ["x", '"y;z"', "", "w"], "b": ['"1;2;3;4;5;6;7;8;9"']}
    assert {r.file[-1]: r.open for r in files.collect()} == {"a": True, "b": False}
