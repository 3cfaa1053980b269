"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits, cut into two blocks of 32. Fingerprints that differ in at most
three bits differ in at most one bit of some block. The anchors of a block are the words of
a covering code: the perfect Hamming code of 31 bits (radius 1) times the free 32nd bit. Every
fingerprint is replicated, block by block, to every anchor within radius 1 plus block
threshold 1, that is at most 17 anchors. The nearest anchor of the one then always
lies among the anchors of the other, and only there are fingerprints compared, on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import hold, in_batches, pick, shared_table, utf8
from geopanel.llm.components import components

BITS = 64
#: Two blocks split the bits; the pigeonhole leaves threshold // BLOCKS to the better block.
BLOCKS = 2
#: Nearest anchors that one task compares at once; beyond it a cell is dealt over tasks.
CELL = 4096
#: Comparisons held in memory at once.
PAIRS = 1 << 21


def fingerprint(body: bytes, words: int = 3) -> int:
    """SimHash of the lower-cased words of a UTF-8 text; 0 without words."""
    tokens = body.lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
    hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, hashes.size, 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    bits = np.packbits(2 * ones > hashes.size, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed BIGINT. A missing text has no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(b.as_py(), words) for b in batch["body"]], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print bigint"
    return utf8(docs).mapInArrow(in_batches(run), schema)


# For every syndrome, the bit patterns (of 31 bits) that lead to all code words within two.
_COSETS = [np.array([0], np.uint64)] + [
    np.array([1 << (s - 1)] + [(1 << (i - 1)) | (1 << ((i ^ s) - 1))
                               for i in range(1, 32) if i < i ^ s], np.uint64)
    for s in range(1, 32)
]
_LOW31 = np.uint64((1 << 31) - 1)
_TOP = np.uint64(1 << 31)


def _syndrome(block: np.ndarray) -> np.ndarray:
    """XOR of the numbers (1 to 31) of the bits that are set."""
    out = np.zeros(block.size, np.int64)
    for number in range(1, 32):
        out ^= np.where((block >> np.uint64(number - 1)) & np.uint64(1), number, 0)
    return out


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor, is it the nearest) for all replicas."""
    index, anchor, home = [], [], []
    for block in range(BLOCKS):
        part = (prints >> np.uint64(32 * block)) & np.uint64((1 << 32) - 1)
        tag = np.uint64(block << 32)
        syndrome = _syndrome(part & _LOW31)
        for s, patterns in enumerate(_COSETS):
            who = np.flatnonzero(syndrome == s)
            if not who.size:
                continue
            # The first pattern leads to the nearest anchor; also reach that one with the
            # free bit flipped.
            reached = np.concatenate([part[who][:, None] ^ patterns,
                                      (part[who] ^ patterns[0] ^ _TOP)[:, None]], axis=1)
            index.append(np.repeat(who, reached.shape[1]))
            anchor.append((reached | tag).ravel())
            nearest = np.zeros(reached.shape, bool)
            nearest[:, 0] = True
            home.append(nearest.ravel())
    if not index:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def _replicas(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = batch["print"].to_numpy(zero_copy_only=False)
    index, anchor, home = anchors(prints.view(np.uint64))
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor.view(np.int64)), pa.array(prints[index]), pa.array(home)],
        names=["anchor", "print", "home"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked value beside the least value of its component: one link per value."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:a.size], ends[a.size:]
    label = np.arange(nodes.size)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(nodes.size)
    return nodes[moved], nodes[label[moved]]


def _compare(cell: np.ndarray, prints: np.ndarray, home: np.ndarray, threshold: int):
    """Links among sorted cells, each nearest fingerprint against its whole cell."""
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[first, cell.size])
    begin, length = np.repeat(first, size), np.repeat(size, size)
    left = np.flatnonzero(home & (length > 1))
    while left.size:
        upto = max(1, int(np.searchsorted(np.cumsum(length[left]), PAIRS, side="right")))
        now, left = left[:upto], left[upto:]
        n = length[now]
        i = np.repeat(now, n)
        j = np.repeat(begin[now], n) + np.arange(i.size) - np.repeat(np.cumsum(n) - n, n)
        x, y = prints[i], prints[j]
        near = (x != y) & (np.bitwise_count(x ^ y) <= threshold)
        if near.any():
            yield _forest(x[near].view(np.int64), y[near].view(np.int64))


def _links(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch[i].to_numpy(zero_copy_only=False) for i in range(4)]
            # The last cell may go on in the next batch; it is put together once it ends.
            cut = int(np.argmax((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])))
            if held and (cut or any(rows[k][0] != held[0][k][-1] for k in (0, 1))):
                held.append([x[:cut] for x in rows])
                yield from emit([np.concatenate(x) for x in zip(*held, strict=True)])
                held = []
            elif cut:
                yield from emit([x[:cut] for x in rows])
            held.append([x[cut:] for x in rows])
        if held:
            yield from emit([np.concatenate(x) for x in zip(*held, strict=True)])

    def emit(rows):
        anchor, salt, prints, home = rows
        if not anchor.size:
            return
        cell = np.cumsum(np.r_[0, (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])])
        for u, v in _compare(cell, prints.view(np.uint64), home, threshold):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def cells(distinct: DataFrame) -> DataFrame:
    """(anchor, salt, print, home): the fingerprints that meet at each anchor.

    A cell with more than ``CELL`` fingerprints is dealt over several salts, parts of its
    nearest fingerprints meeting parts of all; one without any nearest fingerprint has nothing
    to compare and is dropped here, before it is gathered.
    """
    placed = distinct.select("print").mapInArrow(
        in_batches(_replicas), "anchor bigint, print bigint, home boolean")
    counted = placed.groupBy("anchor").agg(
        F.count("*").alias("n"), F.count_if("home").alias("homes"))
    hot = shared_table(counted.filter(F.col("n") > CELL).select(
        "anchor", F.ceil(F.col("homes") / CELL).cast("int").alias("rows"),
        F.ceil(F.col("n") / CELL).cast("int").alias("columns")), "hot-cells")
    # Row i of a hot cell's grid holds a part of its nearest fingerprints, column j a part of
    # all its fingerprints.
    number = F.xxhash64("print")
    column = F.pmod(number, F.col("columns")).cast("int")
    row = F.pmod(number, F.col("rows")).cast("int")
    nowhere = F.array().cast("array<struct<salt:bigint,home:boolean>>")

    def salt(i, j):
        return i.cast("bigint") * F.col("columns") + j

    copies = F.when(F.col("rows").isNull(), F.array(F.struct(
        F.lit(0).cast("bigint").alias("salt"), F.col("home").alias("home")))).when(
        F.col("rows") > 0, F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.struct(
            salt(i, column).alias("salt"), F.lit(False).alias("home")))).otherwise(nowhere)
    rows_of = F.when(F.col("rows").isNotNull() & F.col("home"), F.transform(
        F.sequence(F.lit(0), F.col("columns") - 1), lambda j: F.struct(
            salt(row, j).alias("salt"), F.lit(True).alias("home")))).otherwise(nowhere)
    dealt = placed.join(hot, "anchor", "left").select(
        "anchor", "print", F.explode(F.concat(copies, rows_of)).alias("at"))
    return dealt.select("anchor", F.col("at.salt").alias("salt"), "print",
                        F.col("at.home").alias("home"))


def near_links(distinct: DataFrame, threshold: int = 3) -> DataFrame:
    """(u, v): links that connect all different fingerprints within ``threshold`` bits.

    Not every pair is emitted: what one comparison finds is reduced to one link per
    fingerprint with the same components.
    """
    if threshold // BLOCKS > 1:
        raise ValueError("the covering of two blocks reaches at most 3 bits")
    meeting = cells(distinct).repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    return meeting.mapInArrow(_links(threshold), "u bigint, v bigint")


def simhash_components(docs: DataFrame, words: int = 3, threshold: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id.

    Words are runs of non-blank characters, A-Z lower-cased; a shingle is ``words`` of them.
    Fingerprints at most ``threshold`` bits apart are linked; component_id is the least doc_id
    that can be reached. A null or empty text has fingerprint 0, linked like any other. Equal
    fingerprints are one node, so copies are never paired. Repeated rows stay; a null doc_id
    keeps its row and counts for a component only if there is no other. Extra columns are
    ignored; an empty table gives an empty result.
    """
    prints = shared_table(fingerprints(pick(docs, "doc_id", "text"), words), "prints")
    distinct = shared_table(
        prints.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(near_links(distinct, threshold))
    nodes = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = nodes.join(named, "root").select("print", "component_id")
    return prints.join(of_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, threshold: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its component, with all columns.

    Repeated rows of one doc_id are one document and stay; so do rows without doc_id.
    """
    held, back = hold(docs, "doc_id", "text")
    grouped = simhash_components(held, words, threshold)
    gone = grouped.filter("doc_id != component_id").select("doc_id").distinct()
    return back(held.join(gone, "doc_id", "left_anti"))
