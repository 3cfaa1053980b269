from __future__ import annotations

import pytest

import corpus_pipeline
from geopanel.llm import simhash
from geopanel.llm.queries import ORACLES, QUERIES
from tests.llm import test_linededup, test_mixing, test_packing, test_quality, test_simhash
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_all_queries_and_five_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "mixing", "packing"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]

    def step(i, frame):
        out = stages[i](spark, frame, SF)
        out.write.parquet(str(tmp_path / str(i)))
        return spark.read.parquet(str(tmp_path / str(i)))

    def texts(frame):
        return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}

    given = texts(docs)
    good = step(0, docs)
    assert good.columns == docs.columns
    measured = {d: test_quality.slow(t) for d, t in given.items()}
    # No source of this table fails as a host, so the base rules decide.
    assert set(texts(good)) == {d for d, m in measured.items()
                                if m[0] >= 20 and 100 * m[5] <= 30 * m[0]}
    short = step(1, good)
    wanted = test_linededup.slow(texts(good), 30, over_blank=True)
    assert texts(short) == {d: t for d, t in wanted.items() if t}
    assert short.filter("n_chars != char_length(text)").count() == 0
    single = step(2, short)
    prints = [(d, test_simhash.slow_print(t)) for d, t in sorted(texts(short).items())]
    roots = test_simhash.slow_components(prints)
    assert set(texts(single)) == set(roots.values())
    mixed = step(3, single)
    assert mixed.columns == docs.columns
    before, after = texts(single), texts(mixed)
    words = {d: len(t.split()) for d, t in before.items()}
    share = sum(words[d] for d in after) / sum(words.values())
    assert set(after) <= set(before) and 0.5 < share <= 0.95
    pieces = step(4, mixed).collect()
    test_packing.check(pieces, after, 2048)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.ids_crc32 for r in whole) == sorted(r.ids_crc32 for r in pieces)


@pytest.mark.parametrize("stage", range(5))
def test_odd_rows_in_every_stage(spark, odd, stage):
    run = corpus_pipeline.STAGES[stage][1]
    out = run(spark, odd, SF)
    if stage < 4:
        assert out.columns == list(corpus_pipeline.COLUMNS)
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in odd.collect()}
    assert run(spark, odd.limit(0), SF).collect() == []


def test_modules_of_the_helpers_are_used():
    assert test_mixing.slow([], 1.0, 1, 1) == []
    assert simhash.BITS == 64
