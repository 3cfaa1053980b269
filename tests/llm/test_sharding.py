from __future__ import annotations

import zlib
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from geopanel.llm import sharding
from geopanel.llm.common import pick
from geopanel.llm.queries import op13_sharding


def network(x, n, seed):
    """One pass over the numbers below a * b, in whole numbers of Python."""
    a, b = sharding.halves(n)
    left, right = x % a, x // a
    for turn in range(sharding.ROUNDS):
        half = left if turn % 2 else right
        key = int(md5(f"{seed}:{turn}:{half}".encode()).hexdigest()[:15], 16)
        if turn % 2:
            right = (right + key) % b
        else:
            left = (left + key) % a
    return left + right * a


def place(x, n, seed):
    x = network(x, n, seed)
    while x >= n:
        x = network(x, n, seed)
    return x


def slow(rows, shards, seed):
    def digest(row):
        inner = "-" if row[1] is None else md5(row[1].encode()).hexdigest()
        return md5(f"{'-' if row[0] is None else row[0]}:{inner}".encode()).hexdigest()

    out = []
    for number, (doc_id, text) in enumerate(sorted(rows, key=digest)):
        body = (text or "").encode()
        at = place(number, len(rows), seed)
        out.append((doc_id, len(body) + 1, zlib.crc32(body), at % shards, at // shards))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in df.collect()),
                  key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 101, 257])
def test_same_as_brute_force(documents, n):
    rows = [(i, f"text {i % 7}") for i in range(n)]
    df = sharding.shard_documents(documents(rows), 4, seed=n)
    assert got(df) == slow(rows, 4, n)


@pytest.mark.parametrize("together", [3, 1 << 16])
def test_repeated_rows_and_partitions_do_not_matter(documents, monkeypatch, together):
    monkeypatch.setattr(sharding, "TOGETHER", together)
    monkeypatch.setattr(sharding, "BUCKET", 1)
    rows = [(i, f"t{i}") for i in range(60)] + [(None, "copy")] * 40 + [(5, None)] * 9
    for parts in (1, 7):
        df = sharding.shard_documents(documents(rows).repartition(parts), 16, seed=42)
        found = got(df)
        assert found == slow(rows, 16, 42)
    for shard in range(16):
        slots = sorted(r[4] for r in found if r[3] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (6, 7)


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12, 50, 1000, 4097])
def test_a_permutation_and_its_inverse(spark, n):
    steps = sharding.walk_length(spark, n, 5)
    back = sharding.walk_length(spark, n, 5, back=True)
    rows = spark.range(n).withColumn("p", sharding.permuted(F.col("id"), n, 5, steps))
    rows = rows.withColumn("q", sharding.row_at(F.col("p") % 3, F.floor(F.col("p") / 3), n, 3, 5,
                                                back)).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.id == r.q for r in rows)
    assert [r.p for r in rows] == [place(i, n, 5) for i in range(n)]


def test_equal_texts_are_spread(documents):
    rows = [(i, "same") for i in range(800)]
    counts = sharding.shard_documents(documents(rows), 16).groupBy("shard").count().collect()
    assert {r["count"] for r in counts} == {50}


def test_written_shards_hold_their_rows_in_order(documents, monkeypatch, spark):
    monkeypatch.setattr(sharding, "FILE_ROWS", 8)
    rows = [(i, f"t{i}") for i in range(100)]
    path = sharding.write_shards(documents(rows), 4, carry=("text", "lang"))
    back = spark.read.parquet(path)
    assert sorted(r.text for r in back.collect()) == sorted(t for _, t in rows)
    files = back.select("shard", "slot", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in files:
        by_file.setdefault((r.shard, r.f), []).append(r.slot)
    assert all(slots == sorted(slots) for slots in by_file.values())
    assert len(by_file) > 4


def test_odd_rows(odd, spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in pick(odd, "doc_id", "text").collect()]
    assert got(sharding.shard_documents(odd, 16)) == slow(rows, 16, 42)
    assert sharding.shard_documents(odd.limit(0), 16).collect() == []
    pick(odd, "doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_sharding(spark, str(tmp_path))
    assert found.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot",
                                 "grown_shard"]
    assert dict(found.dtypes) | {"doc_id": "bigint"} == dict(found.dtypes)
    assert found.count() == len(rows)
