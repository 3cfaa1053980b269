from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from geopanel.llm import negatives
from geopanel.llm.negatives import LEAST, MOST, Best, Index, Side, exact_scores, fill
from geopanel.llm.queries import op11_hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def whole(v):
    return None if v is None or any(x is None or not math.isfinite(x) for x in v) else \
        tuple(math.floor(Fraction(x) * 256) for x in v)


def slow(rows, every, positives=5, wanted=3, low=50, high=95):
    rows = {(i, c, tuple(v)) for i, c, v in rows
            if i is not None and c is not None and whole(v) is not None}
    rows = [(i, c, whole(v)) for i, c, v in rows]
    out = []
    for a, c, q in rows:
        if a % every:
            continue
        scored = sorted(
            (-max(LEAST, min(MOST, sum(map(int.__mul__, q, v)))), i, k)
            for i, k, v in rows if i != a and len(v) == len(q))
        for p, pid, _ in [s for s in scored if s[2] == c][:positives]:
            p = -p
            bad = [s for s in scored if s[2] != c and low * p <= -100 * s[0] <= high * p]
            out += [(a, pid, n, i, p, -s) for n, (s, i, _) in enumerate(bad[:wanted], 1)]
    return sorted(out)


def got(spark, rows, **more):
    found = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), **more)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def some_rows(n, labels, dim, seed, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    return [(i, k := draw.randrange(labels),
             [c + spread * draw.gauss(0, 1) for c in centres[k]]) for i in range(n)]


@pytest.mark.parametrize("n, labels, dim, spread, seed", [
    (300, 4, 20, 0.3, 1), (300, 3, 7, 2.0, 2), (200, 40, 12, 1.0, 3), (120, 1, 5, 1.0, 4),
    (400, 2, 33, 0.1, 5)])
def test_same_as_brute_force(spark, monkeypatch, n, labels, dim, spread, seed):
    monkeypatch.setattr(negatives, "CANDIDATES", 90)
    monkeypatch.setattr(negatives, "ANCHORS", 11)
    monkeypatch.setattr(negatives, "TILE", (37, 7))
    rows = some_rows(n, labels, dim, seed, spread)
    assert got(spark, rows, every=7) == slow(rows, 7)


def test_one_common_vector_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", (16, 8))
    rows = [(i, i % 2, [0.5, 0.25, -0.5]) for i in range(150)]
    rows += [(200 + i, 2, [0.4, 0.25, -0.4 + i / 90]) for i in range(40)]
    rows += rows[:20] + [(0, 1, [0.1, 0.1, 0.1]), (10, 0, [0.5, 0.2, -0.5])]
    assert got(spark, rows, every=10) == slow(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (5, 1, [1.0, 1.9]), (6, 2, [1.0, 1.5]), (7, 2, [0.9, 1.0]),
            (8, None, [1.0, 2.0]), (9, 2, None), (11, 2, [1.0, None]), (12, 2, [nan, 1.0]),
            (13, 2, [inf, 1.0]), (None, 2, [1.0, 1.5]), (14, 2, [1.0]), (15, 1, [0.0, 0.0]),
            (20, 3, []), (21, 3, []), (22, 4, []), (25, 5, [0.0, 0.0]), (30, 5, [-1.0, -2.0]),
            (-5, 1, [-0.001, 0.0]), (35, 6, [1e160, 1.0]), (36, 6, [1e150, 1.0]),
            (37, 7, [1e149, 2.0]), (38, 7, [3e7, -1e7]), (40, 6, [2e7, 1e7]), (41, 7, [1e7, 1e6])]
    assert got(spark, rows, every=5) == slow(rows, 5)
    assert got(spark, [], every=5) == []
    clash = spark.createDataFrame(
        [(*r, 1, "x", [1.0]) for r in rows], SCHEMA + ", row int, id string, v array<double>")
    found = negatives.hard_negatives(clash, every=5).collect()
    assert sorted(map(tuple, found)) == slow(rows, 5)


@pytest.mark.parametrize("seed", range(6))
def test_fill_finds_all(seed):
    draw = np.random.default_rng(seed)
    dim = int(draw.integers(1, 40))
    x = np.floor(draw.normal(size=(300, dim)) * draw.uniform(1, 200, dim))
    q = np.floor(draw.normal(size=(20, dim)) * 50)

    def rows(v):
        return Side(np.arange(len(v)), draw.permutation(len(v)) + 100 * (len(v) < 50),
                    draw.integers(0, 3, len(v)), v, False)

    anchors, others = rows(q), rows(x)
    score = (others.x @ anchors.x.T).astype(np.int64)
    middle = np.sort(score, 0)[[-2, -60, 150]].T
    low, high = np.stack([middle - 4000] * 2, 2)[..., 0], middle
    best = Best(20, 3, 4)
    for at in range(0, 300, 80):
        fill(anchors, others.take(slice(at, at + 80)), low, high, best, 0, same=False)
    where, window, found, ids = best.rows()
    for i in range(20):
        for w in range(3):
            pairs = sorted((-s, d) for s, d, c in zip(
                score[:, i].tolist(), others.id.tolist(), others.label.tolist(), strict=True)
                if c != anchors.label[i] and d != anchors.id[i] and low[i, w] <= s <= high[i, w])
            mine = (where == i) & (window == w)
            assert list(zip((-found[mine]).tolist(), ids[mine].tolist(), strict=True)) == pairs[:4]


def test_high_thresholds_leave_components_out():
    draw = np.random.default_rng(1)
    x = np.floor(draw.normal(size=(2000, 64)) * np.geomspace(100, 1, 64))
    index = Index(x, x[:50])
    rows, anchors, score = index.reach(0.9 * index.q_rest[:, 0] * index.x_rest[:, 0].max())
    assert index.depth.mean() < 0.9 * index.groups
    true = x @ x[:50].T
    hit = np.argwhere(true >= 0.9 * index.q_rest[:, 0] * index.x_rest[:, 0].max())
    assert {tuple(h) for h in hit} <= set(zip(rows.tolist(), anchors.tolist(), strict=True))
    assert (score == true[rows, anchors]).all()
    assert len(rows) < true.size / 20


def test_scores_of_any_size():
    big = np.array([[1 << 100, 3]], object)
    assert exact_scores(big, np.array([[1, 1], [-(1 << 90), 0], [0, 7]], object)).tolist() == [
        [MOST, LEAST, 21]]
    # Beyond what doubles hold: whole numbers beside a block of doubles.
    big = np.array([[(1 << 60) + 1, 1]], object)
    assert exact_scores(big, np.array([[3.0, -1.0]])).tolist() == [[3 * ((1 << 60) + 1) - 1]]


def test_query_has_its_columns(spark, tmp_path):
    rows = [(i, k % 10, v) for i, k, v in some_rows(300, 10, 8, 9, 0.5)]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    assert op11_hard_negatives(spark, str(tmp_path)).columns == COLUMNS
    shifted = [(i, (k + 1) % 10 if i % 7 == 0 else k, [float(np.float32(x)) for x in v])
               for i, k, v in rows]
    found = op11_hard_negatives(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == slow(shifted, 50)
