from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from geopanel.llm import simhash
from geopanel.llm.components import components


def slow_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """doc -> least doc reachable over at most three differing bits; ``prints``: (doc, print)."""
    root = {d: d for d, _ in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 3 and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d, _ in prints}


def words(draw, n):
    return " ".join(draw.choice(["ab", "cd", "Ef", "gh,", "éa", "x1"]) + str(draw.randint(0, 40))
                    for _ in range(n))


def test_same_as_brute_force(documents):
    draw = random.Random(5)
    texts = [words(draw, draw.choice([1, 2, 3, 5, 60, 300])) for _ in range(60)]
    near = [t.replace(t.split()[3], "other", 1) for t in texts if len(t.split()) > 200] * 2
    rows = list(enumerate([*texts, *near, "", "\n", None, *texts[:5], "A B", "a b"], 100))
    found = simhash.simhash_components(documents(rows)).collect()
    prints = [(d, slow_print(t)) for d, t in rows]
    assert {r.doc_id: r.fingerprint for r in found} == {d: f"{p:016x}" for d, p in prints}
    assert {r.doc_id: r.component_id for r in found} == slow_components(prints)
    assert len(found) == len(rows)


def test_every_close_pair_meets_at_an_anchor():
    draw = np.random.default_rng(3)
    left = draw.integers(0, 1 << 63, 4000, dtype=np.uint64)
    flips = np.zeros_like(left)
    for _ in range(3):
        flips |= np.uint64(1) << draw.integers(0, 64, left.size).astype(np.uint64)
    right = left ^ flips

    def placed(prints):
        index, anchor, home = simhash.anchors(prints)
        every, nearest = [set() for _ in prints], [set() for _ in prints]
        for i, a, h in zip(index, anchor, home, strict=True):
            every[i].add(int(a))
            if h:
                nearest[i].add(int(a))
        assert all(len(e) <= 34 and len(n) == 2 and n <= e
                   for e, n in zip(every, nearest, strict=True))
        return every, nearest

    every, _ = placed(left)
    _, nearest = placed(right)
    assert all(e & n for e, n in zip(every, nearest, strict=True))


@pytest.mark.parametrize("cell", [4096, 3])
def test_dense_groups_lose_no_link(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "PAIRS", 64)
    draw = random.Random(9)
    middle = [draw.getrandbits(64) for _ in range(4)]
    prints = {m for m in middle} | {0, (1 << 64) - 1}
    for m in middle:
        for _ in range(60):
            x = m
            for _ in range(draw.randint(1, 6)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "print bigint"))
    got = {r.node: r.root for r in components(links).collect()}
    wanted = slow_components([(s, s % (1 << 64)) for s in sorted(signed)])
    assert {s: got.get(s, s) for s in signed} == wanted


def test_one_block_that_many_share(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 512)
    draw = random.Random(11)
    low = {draw.getrandbits(31) for _ in range(20_000)}
    frame = spark.createDataFrame([(0x1234567 << 32 | x,) for x in low], "print bigint")
    sizes = simhash.cells(frame).groupBy("anchor", "salt").agg(
        F.count("*").alias("n"), F.count_if("home").alias("homes")).collect()
    # Each part holds its share of the nearest and of all, however many share the block.
    assert max(r.n for r in sizes) < 2 * 512 * 1.3
    assert all(r.homes for r in sizes if r.n > 512)
    # All meet at the nearest anchor of the block, and only there.
    assert sum(r.n > 512 for r in sizes) <= 40 * 40


def test_cells_over_many_batches(spark):
    draw = random.Random(12)
    rows = [(a, draw.randrange(2), p, draw.random() < 0.2) for a in range(5)
            for p in {draw.getrandbits(10) for _ in range(draw.choice([1, 40, 300]))}]
    rows.sort(key=lambda r: r[:2])

    def links(width):
        batches = [pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*rows[i:i + width], strict=True)], names=list("aspx"))
            for i in range(0, len(rows), width)]
        return components(spark.createDataFrame(
            [r for out in simhash._links(1)(iter(batches)) for r in
             zip(*out.to_pydict().values(), strict=True)], "a bigint, b bigint")).collect()

    whole = sorted(links(len(rows)))
    assert whole and all(sorted(links(width)) == whole for width in (1, 7, 64))


def test_chains_of_links(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (200, 300)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint"))
           .collect()}
    assert got == {(i, 0) for i in range(41)} | {(90, 90), (100, 90), (200, 200), (300, 200)}
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components(none).count() == 0


def test_odd_rows(odd):
    found = simhash.simhash_components(odd).collect()
    assert len(found) == odd.count()
    zero = [r for r in found if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {1}
    assert {r.component_id for r in found if r.doc_id == 4} == {4}
    assert simhash.simhash_components(odd.limit(0)).collect() == []
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 4, 7, 8, 9, 10}
