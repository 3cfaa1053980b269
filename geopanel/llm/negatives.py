"""Hard negatives by threshold joins over an inverted index with norm bounds.

Vectors of whole numbers are cut into blocks. A block of candidates is indexed by groups of
components, those with the most weight first, each with the list of rows it holds for. A row
is left out of the lists from the group on whose remaining norm can't lift a score to the
threshold. Partial scores are accumulated over the lists; pairs that can't reach their threshold
with what the remaining norms allow are pruned, the others are scored in full. Thresholds start
high and are lowered, and the lists carried on, until every window has what it wants.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geopanel.llm.common import pick, shared_table

#: Candidates and anchors that one task brings together.
CANDIDATES = 8192
ANCHORS = 32768
#: Candidates and anchors of a tile, whose partial scores are held at once.
TILE = (2048, 1024)
#: Components that share a list of the index.
GROUP = 8
#: Parts of the way down to the lowest threshold of use, by round.
SHARES = (1 / 32, 1 / 8, 1 / 2, 1)
#: Pairs scored in one go.
PAIRS = 1 << 16
#: Squared norm below which sums of products are exact in double precision.
EXACT = float(1 << 51)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass
class Side:
    """Vectors of one tile with the numbers of their rows, ids and labels."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    wide: bool

    def take(self, at) -> Side:
        return Side(self.row[at], self.id[at], self.label[at], self.x[at], self.wide)


class Best:
    """The highest scores per anchor and window, at most ``want``, ties to the smaller id."""

    def __init__(self, anchors: int, windows: int, want: int):
        self.want, self.windows = want, windows
        self.score = np.full((anchors * windows, want), LEAST, np.int64)
        self.id = np.full((anchors * windows, want), MOST, np.int64)
        self.count = np.zeros(anchors * windows, np.int64)

    def add(self, anchor: np.ndarray, window: int, score: np.ndarray, id_: np.ndarray) -> None:
        if not anchor.size:
            return
        key = anchor * self.windows + window
        known = np.unique(key)
        held = np.arange(self.want) < self.count[known, None]
        key = np.concatenate([key, np.repeat(known, self.count[known])])
        score = np.concatenate([score, self.score[known][held]])
        id_ = np.concatenate([id_, self.id[known][held]])
        order = np.lexsort((id_, ~score, key))
        key, score, id_ = key[order], score[order], id_[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(start, key.size))
        nth = np.arange(key.size) - np.repeat(start, sizes)
        keep = nth < self.want
        self.score[key[keep], nth[keep]] = score[keep]
        self.id[key[keep], nth[keep]] = id_[keep]
        self.count[known] = np.minimum(sizes, self.want)

    def least(self) -> np.ndarray:
        """By anchor and window, the score below which nothing more is of use."""
        full = self.count == self.want
        return np.where(full, self.score[:, -1], LEAST).reshape(-1, self.windows)

    def rows(self):
        """(place of the anchor, window, score, id) of all that is held."""
        held = np.arange(self.want) < self.count[:, None]
        key = np.repeat(np.arange(self.count.size), self.count)
        return key // self.windows, key % self.windows, self.score[held], self.id[held]


class Index:
    """Lists of rows by group of components, as deep as a threshold needs, with partial scores."""

    def __init__(self, x: np.ndarray, q: np.ndarray):
        order = np.argsort(-(x ** 2).sum(0), kind="stable")
        self.x, self.q = x[:, order], q[:, order]
        self.groups = -(-x.shape[1] // GROUP)
        # Norms of what remains from each group on.
        self.x_rest, self.q_rest = self._rest(self.x), self._rest(self.q)
        self.depth = np.zeros(len(x), np.int64)
        self.partial = np.zeros((len(x), len(q)))

    def _rest(self, x: np.ndarray) -> np.ndarray:
        squares = np.zeros((len(x), self.groups + 1))
        for g in range(self.groups):
            squares[:, g] = (x[:, g * GROUP:(g + 1) * GROUP] ** 2).sum(1)
        # A little more than the norm, whatever the rounding.
        return np.sqrt(squares[:, ::-1].cumsum(1)[:, ::-1]) * (1 + 1e-12)

    def only(self, keep: np.ndarray) -> None:
        """Go on with these anchors."""
        self.q, self.q_rest, self.partial = (
            self.q[keep], self.q_rest[keep], self.partial[:, keep])

    def deepen(self, depth: np.ndarray) -> None:
        """Carry the lists on so that row i is in the first ``depth[i]`` of them."""
        for g in range(self.groups):
            rows = np.flatnonzero((self.depth <= g) & (depth > g))
            if rows.size:
                part = slice(g * GROUP, (g + 1) * GROUP)
                step = self.x[rows, part] @ self.q[:, part].T
                if rows.size == len(self.x):
                    self.partial += step
                else:
                    self.partial[rows] += step
        self.depth = np.maximum(self.depth, depth)

    def hits(self, threshold: np.ndarray, rows=slice(None)) -> np.ndarray:
        """By row and anchor: may the score reach the anchor's threshold?"""
        depth = self.depth[rows]
        rest = np.take_along_axis(self.x_rest[rows], depth[:, None], 1)
        bound = self.partial[rows] + rest * self.q_rest.T[depth]
        return bound * (1 + np.sign(bound) * 1e-12) + 1e-6 >= threshold

    def reach(self, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, anchors, scores) of a superset of the pairs with their threshold or more."""
        norm = self.q_rest[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            per_norm = np.where(norm > 0, threshold / norm, np.where(threshold <= 0, -1, np.inf))
        needed = (self.x_rest[:, :-1] >= per_norm.min()).sum(1)
        self.deepen(np.maximum(needed, self.depth))
        hit = self.hits(threshold)
        # Rows with many pairs left are cheaper to carry to the end for all anchors at once.
        deep = (hit.sum(1) > hit.shape[1] // 16) & (self.depth < self.groups)
        if deep.any():
            self.deepen(np.where(deep, self.groups, self.depth))
            hit[deep] = self.hits(threshold, deep)
        rows, anchors = np.nonzero(hit)
        score = self.partial[rows, anchors]
        short = np.flatnonzero(self.depth[rows] < self.groups)
        for at in range(0, short.size, PAIRS):
            some = short[at:at + PAIRS]
            score[some] = np.einsum("ij,ij->i", self.x[rows[some]], self.q[anchors[some]])
        return rows, anchors, score.astype(np.int64)


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of all rows as whole numbers of any size, cut to 64 bits."""
    x, q = (v if v.dtype == object else v.astype(np.int64).astype(object) for v in (x, q))
    found = x @ q.T if x.shape[1] else np.zeros((len(x), len(q)))
    return np.clip(found, LEAST, MOST).astype(np.int64)


def fill(q: Side, x: Side, low: np.ndarray, high: np.ndarray, best: Best, base: int,
         same: bool) -> None:
    """Put into ``best`` what the candidates ``x`` have for the windows of the anchors ``q``.

    ``low`` and ``high`` are the ends of the windows by anchor; anchor i is ``base + i`` in
    ``best``. Only pairs of the same label (the caller gives no others) or of different labels.
    """

    def keep(rows, at, score, who, least, before=None, threshold=None):
        anchors = who[at]
        good = q.id[anchors] != x.id[rows]
        if not same:
            good &= q.label[anchors] != x.label[rows]
        if before is not None:
            good &= (score >= threshold[at]) & (score < before[anchors])
        rows, anchors, score = rows[good], anchors[good], score[good]
        for w in range(best.windows):
            inside = ((score >= low[anchors, w]) & (score <= high[anchors, w])
                      & (score >= least[anchors, w]))
            best.add(base + anchors[inside], w, score[inside], x.id[rows[inside]])

    span = slice(base, base + len(q.id))
    everyone = np.arange(len(q.id))
    if q.wide or x.wide:
        rows, at = (a.ravel() for a in np.indices((len(x.id), len(q.id))))
        keep(rows, at, exact_scores(x.x, q.x).ravel(), everyone, best.least()[span])
        return
    index = Index(x.x, q.x)
    top = index.q_rest[:, 0] * index.x_rest[:, 0].max()
    bottom = -top - 1
    top = np.minimum(top, high.max(1).astype(float))
    before = np.full(len(q.id), np.inf)
    who = everyone
    for share in SHARES:
        least = np.maximum(low, best.least()[span])
        useful = np.where(low > high, np.inf, least.astype(float))
        open_ = (useful < before[:, None]) & (useful <= top[:, None])
        still = open_[who].any(1)
        if not still.any():
            return
        index.only(still)
        who = who[still]
        floor = np.maximum(np.where(open_, useful, np.inf).min(1)[who], bottom[who])
        full = (best.count.reshape(-1, best.windows)[span] == best.want) | ~open_
        down = np.where(full.all(1)[who], 1, share)
        threshold = np.minimum(top[who] - down * (top[who] - floor), before[who])
        threshold = np.where(down == 1, floor, threshold)
        rows, at, score = index.reach(threshold)
        keep(rows, at, score, who, least, before, threshold)
        before[who] = threshold


def _vectors(scale: int, dim: int, body: bytes, n: int, wide: bool) -> np.ndarray:
    """floor(scale * component): as doubles, which hold them, or as whole numbers of any size."""
    plain = np.frombuffer(body, np.float64).reshape(n, dim)
    if not wide:
        return np.floor(plain * scale)
    # From 2^53 on a double is whole by itself, and so the product needs no rounding.
    return np.array([[int(v) * scale if abs(v) >= 1 << 53 else int(np.floor(v * scale))
                      for v in row] for row in plain.tolist()], object).reshape(n, dim)


def _opened(blocks: pa.Table, scale: int) -> Side:
    """The side that the single row of ``blocks`` holds."""
    r = blocks.slice(0, 1).to_pylist()[0]
    row, id_, label = (np.frombuffer(r[c], np.int64) for c in ("rows", "ids", "labels"))
    return Side(row, id_, label, _vectors(scale, r["dim"], r["body"], row.size, r["wide"]),
                r["wide"])


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of about ``size`` vectors of one dimension, as bytes; ``more`` goes along."""
    kind = ["dim", "wide"]
    counts = rows.groupBy(*kind).agg(F.count(F.lit(1)).alias("n"))
    dealt = rows.join(counts, kind).withColumn(
        "number", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / size)))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()

        def packed(name):
            values = group[name].chunk(0)
            values = values.flatten() if pa.types.is_list(values.type) else values
            return pa.array([values.to_numpy(zero_copy_only=False).tobytes()], pa.binary())

        first = {n: group[n][:1] for n in ("dim", "wide")}
        name = f"{first['dim'][0]}-{first['wide'][0]}-{group['number'][0]}"
        return pa.table(first | {
            "block": pa.array([name]), "rows": packed("row"), "ids": packed("id"),
            "labels": packed("label"), "body": packed("v"), "goals": packed("goals")})

    return dealt.select("dim", "wide", "number", "row", "id", "label", "v", "goals").groupBy(
        *kind, "number").applyInArrow(
        run, "dim int, wide boolean, block string, rows binary, ids binary, labels binary, "
             "body binary, goals binary")


def _meet(candidates: DataFrame, anchors: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on every block of candidates with every block of anchors of its dimension."""
    pairs = shared_table(
        candidates.select("dim", F.col("block").alias("c")).join(
            anchors.select("dim", F.col("block").alias("a")), "dim").select("c", "a"), "tiles")
    left = candidates.join(pairs, F.col("block") == F.col("c"))
    right = anchors.join(pairs.toDF("with", "own"), F.col("block") == F.col("own"))
    return left.groupBy("c", "a").cogroup(right.groupBy("with", "own")).applyInArrow(run, schema)


def _tiles(q: Side, x: Side):
    """(first anchor, anchors, candidates) of every tile."""
    for i in range(0, len(q.id), TILE[1]):
        for j in range(0, len(x.id), TILE[0]):
            yield i, q.take(slice(i, i + TILE[1])), x.take(slice(j, j + TILE[0]))


def _found(q: Side, best: Best) -> pa.Table:
    anchor, window, score, id_ = best.rows()
    return pa.table({"anchor": pa.array(q.row[anchor]), "goal": pa.array(window.astype(np.int32)),
                     "id": pa.array(id_), "score": pa.array(score)})


def usable(table: DataFrame, scale: int, id_: str, label: str, vector: str) -> DataFrame:
    """(id, label, v, dim, wide) of the rows that take part, repeated rows once."""
    rows = pick(table, id_, label, vector).select(
        F.col(id_).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").filter(~bad)
    # One more than the floor may be off by.
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x) * scale + 1, F.lit(2)))
    return rows.dropDuplicates(["id", "label", "v"]).withColumns(
        {"dim": F.size("v"), "wide": square >= EXACT})


def hard_negatives(table: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256, id_: str = "vec_id",
                   label: str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x) and a score is the inner product of whole numbers,
    cut to 64 bits where it is longer. Anchors are the rows whose id is divisible by ``every``. The
    positives of an anchor are the first ``positives`` rows with its label, the negatives of a
    positive the first ``negatives`` rows with another label and low percent of the
    positive's score at least, high percent at most; first are higher scores, then
    smaller ids. ``rank`` counts the negatives of a positive from 1.

    Rows without id, label or vector and vectors with a null or non-finite component take no
    part. Repeated rows count once; different rows with one id are no candidates for each
    other. Vectors of another length are no candidates, empty ones have score 0. No rows give
    no rows; extra columns are ignored.

    Each block of candidates meets each block of anchors of its dimension, first for
    positives, then for the windows these give; what a block finds is a few rows per window.
    """
    rows = shared_table(
        usable(table, scale, id_, label, vector).withColumn(
            "row", F.monotonically_increasing_id()), "vectors")
    none = F.array().cast("array<bigint>").alias("goals")
    candidates = shared_table(_blocks(rows.select("*", none), CANDIDATES), "candidates")
    asked = rows.filter(F.col("id") % every == 0)
    schema = "anchor bigint, goal int, id bigint, score bigint"

    def same_label(right: pa.Table, left: pa.Table) -> pa.Table:
        x, q = _opened(right, scale), _opened(left, scale)
        best = Best(len(q.id), 1, positives)
        order = np.argsort(q.label, kind="stable")
        q = q.take(order)
        for value in np.intersect1d(q.label, x.label):
            mine = np.flatnonzero(q.label == value)
            for at, some, others in _tiles(q.take(mine), x.take(x.label == value)):
                ends = np.full((len(some.id), 1), LEAST), np.full((len(some.id), 1), MOST)
                fill(some, others, *ends, best, int(mine[0]) + at, same=True)
        return _found(q, best)

    def other_label(right: pa.Table, left: pa.Table) -> pa.Table:
        x, q = _opened(right, scale), _opened(left, scale)
        goals = np.frombuffer(left["goals"][0].as_py(), np.int64).reshape(len(q.id), -1)
        ends = np.array([[_window(p, low, high) for p in line] for line in goals.tolist()],
                        np.int64).reshape(len(q.id), -1, 2)
        best = Best(len(q.id), ends.shape[1], negatives)
        for at, some, others in _tiles(q, x):
            here = ends[at:at + len(some.id)]
            fill(some, others, here[..., 0], here[..., 1], best, at, same=False)
        return _found(q, best)

    def first(found: DataFrame, keys: list[str], want: int) -> DataFrame:
        by = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= want)

    asking = shared_table(_blocks(asked.select("*", none), ANCHORS), "anchors")
    good = shared_table(
        first(_meet(candidates, asking, same_label, schema), ["anchor"], positives).select(
            "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
            (F.col("rank") - 1).alias("goal")), "positives")
    # The scores of an anchor's positives in the order of their ranks, the last one repeated.
    goals = good.groupBy("anchor").agg(F.expr(
        "transform(array_sort(collect_list(struct(goal, positive_score))), x -> x.positive_score)")
        .alias("goals"))
    goals = goals.withColumn("goals", F.slice(F.concat(
        "goals", F.array_repeat(F.element_at("goals", -1), positives)), 1, positives))
    windows = asked.join(goals, asked["row"] == goals["anchor"]).drop("anchor")
    windowed = shared_table(_blocks(windows, ANCHORS), "windows")
    bad = first(_meet(candidates, windowed, other_label, schema), ["anchor", "goal"], negatives)
    return bad.join(good, ["anchor", "goal"]).join(
        asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor"
    ).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
             F.col("id").alias("negative_id"), "positive_score",
             F.col("score").alias("negative_score"))


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the greatest score s with low * score <= 100 * s <= high * score."""
    return max(LEAST, -(-low * score // 100)), min(MOST, high * score // 100)
