"""Nearest neighbours by a block matrix join of int8 tiles with exact re-ranking.

Vectors are cut into blocks. A block of queries and a block of candidates make a tile: one
product of their int8 codes gives all distances between the codes, and these are off by at
most the lengths of both rounding errors, which are known exactly. Whatever can't be among the
nearest by these bounds is dropped; the rest is measured on the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import pick, shared_table

#: Vectors in a block of candidates and of queries.
CANDIDATES = 4096
QUERIES = 2048
#: Candidate blocks that one task holds beside a block of queries.
TILES = 16


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale of each row, length of each row's rounding error)."""
    with np.errstate(over="ignore", under="ignore"):
        scale = np.abs(vectors).max(1) / 127
    scale[scale == 0] = 1.0
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    error = np.sqrt(((vectors - codes * scale[:, None]) ** 2).sum(1))
    return codes, scale, error


def tile_bounds(query, candidate) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances between two quantised blocks."""
    (a, sa, ea), (b, sb, eb) = query, candidate
    # Products of int8 codes are whole numbers; double precision adds them up exactly.
    dot = a.astype(np.float64) @ b.astype(np.float64).T
    na = (a.astype(np.float64) ** 2).sum(1) * sa ** 2
    nb = (b.astype(np.float64) ** 2).sum(1) * sb ** 2
    square = na[:, None] + nb - 2 * dot * sa[:, None] * sb
    # What cancellation and rounding may add to the square.
    slack = 1e-12 * (na[:, None] + nb)
    reach = ea[:, None] + eb
    near = np.sqrt(np.maximum(square - slack, 0)) - reach
    far = np.sqrt(np.maximum(square + slack, 0)) + reach
    # Lengths are 1 at most here; squares of parts below 1e-154 are lost.
    return near * (1 - 1e-12) - 1e-150, far * (1 + 1e-12) + 1e-150


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, added up in the order of the components.

    Each pair is halved or doubled to a length near 1 first and back at the end, which changes
    no digit and lets no square overflow.
    """
    most = np.maximum(np.abs(x).max(1), np.abs(y).max(1))
    power = np.frexp(most)[1]
    x, y = np.ldexp(x, -power[:, None]), np.ldexp(y, -power[:, None])
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        step = x[:, i] - y[:, i]
        total += step * step
    with np.errstate(over="ignore"):
        return np.ldexp(np.sqrt(total), power)


def tile_nearest(queries, candidates, k: int):
    """For each query of a tile its up to ``k`` nearest candidates as (score, id) pairs."""
    (q_ids, q), (c_ids, c) = queries, candidates
    # All bounds of a tile in one unit in which its largest component is below 1.
    power = np.frexp(max(np.abs(q).max(), np.abs(c).max()))[1]
    near, far = tile_bounds(quantised(np.ldexp(q, -power)), quantised(np.ldexp(c, -power)))
    own = q_ids[:, None] == c_ids
    near[own] = far[own] = np.inf
    if c.shape[0] > k:
        limit = np.partition(far, k - 1, axis=1)[:, k - 1]
    else:
        limit = np.full(len(q_ids), np.inf)
    keep = (near <= limit[:, None]) & ~own
    for i in np.flatnonzero(keep.any(1)):
        at = np.flatnonzero(keep[i])
        score = distances(np.broadcast_to(q[i], (at.size, q.shape[1])), c[at])
        yield int(q_ids[i]), heapq.nsmallest(
            k, zip(score.tolist(), c_ids[at].tolist(), strict=True))


def _opened(blocks: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of block rows, one at a time."""
    for dim, ids, body in zip(blocks["dim"], blocks["ids"], blocks["body"], strict=True):
        yield (np.frombuffer(ids.as_py(), np.int64),
               np.frombuffer(body.as_py(), np.float64).reshape(-1, dim.as_py()))


def usable(table: DataFrame, id_: str, vector: str) -> DataFrame:
    """(id, v, dim): vectors as doubles, without null, zero or non-finite ones."""
    rows = pick(table, id_, vector).select(
        F.col(id_).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("v", lambda x: x == 0)
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(
        ~bad & ~zero).withColumn("dim", F.size("v"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """One row per block of about ``size`` vectors of one dimension: ids and vectors as bytes."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group["id"].to_numpy().astype(np.int64)
        vectors = group["v"].chunk(0).flatten().to_numpy(zero_copy_only=False)
        return pa.table({
            "dim": group["dim"][:1], "block": group["block"][:1],
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "body": pa.array([vectors.astype(np.float64).tobytes()], pa.binary())})

    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    number = F.lit(1)
    for dim, n in counts.items():
        number = F.when(F.col("dim") == dim, -(-n // size)).otherwise(number)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), number).cast("int"))
    return dealt.groupBy("dim", "block").applyInArrow(
        run, "dim int, block int, ids binary, body binary")


def nearest(table: DataFrame, k: int = 10, every: int = 100, id_: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest vectors of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those
    with the query's own id. Nearness is the Euclidean distance in double precision; ties
    go to the smaller id. Vectors that are null, zero, or hold a null or non-finite component
    take no part, nor do rows without id; vectors of another length are no candidates.
    Repeated rows count as one. Extra columns are ignored; no vectors give no rows.

    Every block of queries meets every block of candidates of its dimension, in a tile of a
    bounded size; blocks travel, not pairs of rows. A task has a block of queries and up to
    about ``TILES`` blocks of candidates; it keeps the best of its tiles in a heap per query,
    and these are merged by query.
    """
    rows = usable(table, id_, vector).dropDuplicates(["id", "v"])
    rows = shared_table(rows, "vectors")
    candidates = shared_table(_blocks(rows, CANDIDATES), "candidate-blocks")
    queries = shared_table(_blocks(rows.filter(F.col("id") % every == 0), QUERIES), "query-blocks")
    # A block of queries meets the candidate blocks in parts of TILES blocks, so that neither
    # side of a part grows with the table.
    parts = -(-candidates.count() // TILES) or 1
    numbers = queries.groupBy("dim").agg(F.collect_list("block").alias("to"))
    left = candidates.join(numbers, "dim").select(
        "dim", F.explode("to").alias("block"),
        F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), "ids", "body")
    right = queries.select(
        "dim", "block", F.expr(f"explode(sequence(0L, {parts - 1}L)) AS part"), "ids", "body")

    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        best: dict[int, list] = {}
        for query_block in _opened(asked):
            for block in _opened(blocks):
                for query, found in tile_nearest(query_block, block, k):
                    best[query] = list(heapq.merge(best.get(query, []), found))[:k]
        flat = [(q, i, s) for q, found in best.items() for s, i in found]
        q, i, s = zip(*flat, strict=True) if flat else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    key = ["dim", "block", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        run, "query_id bigint, vec_id bigint, score double")

    def merged(group: pa.Table) -> pa.Table:
        # Two rows of one id with different vectors are two candidates of that id.
        top = heapq.nsmallest(k, zip(group["score"].to_pylist(), group["vec_id"].to_pylist(),
                                     strict=True))
        n = len(top)
        return pa.table({
            "query_id": group["query_id"][:1].combine_chunks().take(pa.array([0] * n)),
            "rank": pa.array(range(1, n + 1), pa.int32()),
            "vec_id": pa.array([i for _, i in top], pa.int64()),
            "score": pa.array([s for s, _ in top], pa.float64())})

    return found.groupBy("query_id").applyInArrow(
        merged, "query_id bigint, rank int, vec_id bigint, score double")
