from __future__ import annotations

import math

import numpy as np
import pytest

from geopanel.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def distance(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += (a - b) * (a - b)
    return math.sqrt(total)


def slow(rows, k, every):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and usable(v)}
    out = set()
    for q, x in good.items():
        if q % every == 0:
            near = sorted((distance(x, y), i) for i, y in good.items()
                          if i != q and len(y) == len(x))
            out |= {(q, rank, i, s) for rank, (s, i) in enumerate(near[:k], 1)}
    return out


@pytest.mark.parametrize("sizes", [(4096, 2048), (32, 8)])
def test_same_as_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(neighbours, "CANDIDATES", sizes[0])
    monkeypatch.setattr(neighbours, "QUERIES", sizes[1])
    monkeypatch.setattr(neighbours, "TILES", 3 if sizes[0] < 100 else 16)
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=12).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)]
    rows += [(400 + i, (np.array(rows[i][1]) * 1e6).tolist()) for i in range(20)]
    rows += [(500, [0.0] * 12), (510, None), (520, [1.0] * 11 + [None]), (530, [float("nan")] * 12),
             (540, [float("inf")] * 12), (550, [1.0] * 5), (560, [2.0] * 5), (None, [1.0] * 12),
             (570, []), (580, [1e-30] * 12)]
    rows += rows[:5]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = neighbours.nearest(frame, k=7, every=10).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == slow(rows, 7, 10)
    assert len(got) == len({(r.query_id, r["rank"]) for r in got})


def test_bounds_hold():
    draw = np.random.default_rng(7)
    a, b = draw.normal(size=(40, 30)), draw.normal(size=(50, 30)) * draw.uniform(0.01, 50, (50, 1))
    near, far = neighbours.tile_bounds(neighbours.quantised(a), neighbours.quantised(b))
    true = np.sqrt(((a[:, None] - b) ** 2).sum(2))
    assert (near <= true).all() and (true <= far).all()
    # Tight enough to drop most candidates.
    assert (near > np.partition(far, 9, 1)[:, 9:10]).mean() > 0.3


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(none).collect() == []
    one = spark.createDataFrame([(100, [1.0, 2.0], 1)], SCHEMA)
    assert neighbours.nearest(one).collect() == []
    clash = spark.createDataFrame([(0, [1.0], 1), (1, [3.0], 2)],
                                  "vec_id bigint, embedding array<float>, score int")
    assert [tuple(r) for r in neighbours.nearest(clash).collect()] == [(0, 1, 1, 2.0)]


@pytest.mark.parametrize("sizes", [(4096, 2048), (16, 4)])
def test_vectors_of_any_length(spark, monkeypatch, sizes):
    monkeypatch.setattr(neighbours, "CANDIDATES", sizes[0])
    monkeypatch.setattr(neighbours, "QUERIES", sizes[1])
    draw = np.random.default_rng(8)
    rows = [(i, (draw.normal(size=4) * 10.0 ** p).tolist(), 0)
            for i, p in enumerate([160, 300, 0, -200, 5, 155] * 15)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {}
    for r in neighbours.nearest(frame, k=5, every=10).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert len(got) == 9
    for q, found in got.items():
        true = {i: math.dist(rows[q][1], v) for i, v, _ in rows if i != q}
        nearest = sorted(true.values())[:5]
        assert [found[n][1] for n in range(1, 6)] == pytest.approx(nearest, rel=1e-12)
        assert all(found[n][1] == pytest.approx(true[found[n][0]], rel=1e-12) for n in found)
