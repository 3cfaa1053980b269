"""Removal of line blocks that an earlier document already has, by pairwise alignment."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import hold, pick, shared_table
from geopanel.llm.mixing import word_count


def longest_rising(pairs: list[tuple[int, int]],
                   weights: list[int] | None = None) -> list[tuple[int, int]]:
    """The heaviest subsequence, of pairs sorted by their first part, whose second part rises.

    Without ``weights`` every pair weighs one.
    """
    # Second parts that a chain may end in, with the weight and place of the best such chain;
    # both rise, as an end that another beats with a smaller value is dropped.
    ends: list[int] = []
    totals: list[int] = []
    places: list[int] = []
    back = [-1] * len(pairs)
    for at, (_, value) in enumerate(pairs):
        pile = bisect_left(ends, value)
        total = weights[at] if weights else 1
        if pile:
            back[at] = places[pile - 1]
            total += totals[pile - 1]
        beaten = bisect_right(totals, total, pile)
        if beaten == pile and pile < len(ends) and ends[pile] == value:
            continue
        for held, new in ((ends, value), (totals, total), (places, at)):
            held[pile:beaten] = [new]
    chain, at = [], places[-1] if places else -1
    while at >= 0:
        chain.append(pairs[at])
        at = back[at]
    return chain[::-1]


def patience(a: list[int], b: list[int], words: list[int] | None = None) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, both rising.

    Between two aligned places, equal lines at either end are aligned first; then the lines
    that occur once on either side, in their common order with most ``words`` (those of the
    lines of ``b``; else with most lines); and so on in between.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        places: dict[int, list[int]] = {}
        for i in range(a0, a1):
            places.setdefault(a[i], [0, 0, i, 0])[0] += 1
        for j in range(b0, b1):
            if b[j] in places:
                entry = places[b[j]]
                entry[1] += 1
                entry[3] = j
        once = sorted((e[2], e[3]) for e in places.values() if e[0] == e[1] == 1)
        chain = longest_rising(once, [words[j] for _, j in once] if words else None)
        if not chain:
            continue
        i0, j0 = a0, b0
        for i, j in [*chain, (a1, b1)]:
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        found.extend(chain)
    return sorted(found)


def minimal_runs(stretch: np.ndarray, words: np.ndarray,
                 min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) lines of the shortest runs of ``min_words`` from every line, and up to it.

    Lines of one run have the same number in ``stretch``, which never falls; every line has
    words. Any run of ``min_words`` or more is the union of the shortest ones inside it.
    """
    n = words.size
    total = np.r_[0, np.cumsum(words, dtype=np.int64)]
    least = max(1, min_words)
    at = np.arange(n)
    first = np.r_[at, np.searchsorted(total, total[1:] - least, "right") - 1]
    last = np.r_[np.searchsorted(total, total[:-1] + least) - 1, at]
    inside = (first >= 0) & (last < n)
    first, last = first[inside], last[inside]
    whole = stretch[first] == stretch[last]
    both = np.unique(first[whole] * (n + 1) + last[whole])
    return both // (n + 1), both % (n + 1)


def aligned_blocks(kept: list[tuple[int, int]], later: list[tuple[int, int, int]],
                   min_words: int) -> list[tuple[int, int]]:
    """(first, last) lines of ``later`` in aligned blocks of ``min_words``, by one alignment."""
    pairs = patience([h for _, h in kept], [h for _, h, _ in later], [w for _, _, w in later])
    out: list[tuple[int, int]] = []
    begin, words, before = 0, 0, None
    for i, j in [*pairs, (-1, -1)]:
        now = (kept[i][0], later[j][0]) if i >= 0 else None
        if before is not None and (now is None or now != (before[0] + 1, before[1] + 1)):
            if words >= min_words:
                out.append((begin, end))
            before, words = None, 0
        if now is not None:
            if before is None:
                begin = j
            end, before = j, now
            words += later[j][2]
    return out


def _stretches(rows: list[tuple]) -> np.ndarray:
    return np.cumsum(np.diff([r[0] for r in rows], prepend=rows[0][0]) != 1)


def blocks_of(kept: list[tuple[int, int]], later: list[tuple[int, int, int]],
              min_words: int) -> list[tuple[int, int]]:
    """(first, last) lines of blocks of ``later`` that ``kept`` has too; they may overlap.

    What one alignment leaves, as it crosses what was aligned, is aligned again, as long as
    that deletes an eighth of the rest. Each of the shortest runs with a line that is then
    still there (on the edge of a block, say, or without a line that occurs once) is aligned
    with every place of its rarest line. So no common run of ``min_words`` is left.
    """
    out: list[tuple[int, int]] = []
    gone = np.zeros(len(later), bool)
    left = np.arange(len(later))
    while left.size and kept:
        found = aligned_blocks(kept, [later[j] for j in left.tolist()], min_words)
        # Neighbours in the rest are neighbours in the document, as their positions say.
        blocks = [(int(left[a]), int(left[b])) for a, b in found]
        for a, b in blocks:
            gone[a:b + 1] = True
        out += blocks
        before, left = left.size, np.flatnonzero(~gone)
        if 8 * (before - left.size) < before:
            break
    if not left.size or not kept:
        return out
    places: dict[int, list[int]] = {}
    for i, (_, h) in enumerate(kept):
        places.setdefault(h, []).append(i)
    of_kept = _stretches(kept).tolist()
    first, last = minimal_runs(_stretches(later), np.array([w for *_, w in later]), min_words)
    tried: dict[tuple[int, ...], bool] = {}
    rest = np.r_[0, np.cumsum(~gone)]
    some = rest[last + 1] > rest[first]
    for a, b in zip(first[some].tolist(), last[some].tolist(), strict=True):
        if gone[a:b + 1].all():
            continue
        run = tuple(r[1] for r in later[a:b + 1])
        if run not in tried:
            tried[run] = False
            at = min(range(len(run)), key=lambda x: len(places.get(run[x], ())))
            for i in places.get(run[at], ()):
                low, high = i - at, i - at + b - a
                if low < 0 or high >= len(kept) or of_kept[low] != of_kept[high]:
                    continue
                # Only a run that is aligned from end to end has enough words.
                if aligned_blocks(kept[low:high + 1], later[a:b + 1], min_words) == [(0, b - a)]:
                    tried[run] = True
                    break
        if tried[run]:
            out.append((a, b))
            gone[a:b + 1] = True
    return out


def common_blocks(kept: list[tuple[int, int]], later: list[tuple[int, int, int]],
                  min_words: int) -> list[int]:
    """Positions of the later document's lines in common blocks of ``min_words`` or more.

    ``kept``: (position, line) of the earlier document, ``later``: (position, line, words).
    Only shared lines need be given: a block goes on while both positions go up by one.
    """
    return sorted({later[j][0] for a, b in blocks_of(kept, later, min_words)
                   for j in range(a, b + 1)})


def _lists(batch: pa.RecordBatch, *names: str) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch[n] for n in names)]


#: Base of the hash of a run; odd, so that it has an inverse.
_BASE = 0x9E3779B97F4A7C17


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _runs(min_words: int, over_blank: bool):
    """(doc_id, run, a, b): hashes of the shortest runs of each document, first and last line."""
    back = pow(_BASE, -1, 1 << 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ends, at), (_, line), (_, words) = _lists(batch, "at", "line", "words")
            at, line, words = (x[ends[0]:ends[-1]] for x in (at, line, words))
            ends = ends - ends[0]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            gaps = 0 if over_blank else np.cumsum(np.diff(at, prepend=at[:1]) != 1)
            first, last = minimal_runs(owner + gaps, words, min_words)
            total = np.r_[np.uint64(0), np.cumsum(
                line.view(np.uint64) * _powers(_BASE, line.size), dtype=np.uint64)]
            number = (total[last + 1] - total[first]) * _powers(back, line.size)[first]
            number ^= (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            doc = owner[first]
            for begin in range(0, doc.size, 1 << 16):
                part = slice(begin, begin + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(doc[part])),
                     pa.array(number[part].view(np.int64)),
                     pa.array((first - ends[doc])[part].astype(np.int32)),
                     pa.array((last - ends[doc])[part].astype(np.int32))],
                    names=["doc_id", "run", "a", "b"])

    return run


def _covered(over_blank: bool):
    """Of each document only the lines in runs that a holder has too, with their positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = _lists(batch, "at", "line", "words", "a", "b")
            parts: list[list[np.ndarray]] = [[], [], [], []]
            for i in range(batch.num_rows):
                at, line, words, a, b = (v[ends[i]:ends[i + 1]] for ends, v in lists)
                # Rows of one doc_id with different texts have each other's runs.
                a, b = (x[b < at.size] for x in (a, b))
                step = np.zeros(at.size + 1, np.int64)
                np.add.at(step, a, 1)
                np.add.at(step, b + 1, -1)
                in_run = np.flatnonzero(np.cumsum(step[:-1]))
                pos = in_run if over_blank else at[in_run]
                for held, values in zip(
                        parts, (pos, at[in_run], line[in_run], words[in_run]), strict=True):
                    held.append(values)
            offsets = pa.array(np.cumsum([0, *map(len, parts[0])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["first"], *[
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(held), kind))
                    for held, kind in zip(
                        parts, (pa.int32(), pa.int32(), pa.int64(), pa.int32()), strict=True)]],
                names=["doc_id", "first", "pos", "at", "line", "words"])

    return run


def _aligned(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One row at a time as Python lists; the batch stays in its flat arrays.
            lists = _lists(batch, "k_pos", "k_line", "l_pos", "l_line", "l_words", "l_at")
            at, gone = [], []
            for i in range(batch.num_rows):
                k_pos, k_line, *later, l_at = (
                    values[ends[i]:ends[i + 1]].tolist() for ends, values in lists)
                found = blocks_of(list(zip(k_pos, k_line, strict=True)),
                                  list(zip(*later, strict=True)), min_words)
                if found:
                    at.append(i)
                    gone.append(sorted({x for a, b in found
                                        for x in range(l_at[a], l_at[b] + 1)}))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(at, pa.int64())),
                 pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "gone"])

    return run


def _lines(text: str = "text"):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def repeated_lines(docs: DataFrame, min_words: int, over_blank: bool = False) -> DataFrame:
    """(doc_id, gone): positions, rising, of the lines to delete from each later document.

    Lines are compared by a 64-bit hash of their text, without blank edges. A line without
    words ends a block, or, ``over_blank``, does not count and goes with a block that it
    stands in. Documents are paired through
    the shortest runs of lines that have ``min_words`` words: each holder of a shared run with
    its first holder (least doc_id). Every common block is made of such runs, so it is met,
    and pairs stay linear in the holders: a run that thousands hold needs no cap. A pair is
    aligned on the lines of the later document in runs that it shares with this holder and
    those of the holder in runs that it is the first to have.
    """
    rows = pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL")
    key = rows.schema["doc_id"].dataType.simpleString()
    found = F.filter(F.transform(_lines(), lambda x, i: F.struct(
        i.alias("at"), F.xxhash64(F.trim(x)).alias("line"),
        word_count(x).cast("int").alias("words"))), lambda x: x["words"] > 0)
    lines = shared_table(
        rows.select("doc_id", found.alias("found")).filter(F.size("found") > 0)
        .select("doc_id", "found.at", "found.line", "found.words"), "lines")
    runs = lines.select("doc_id", "at", "line", "words").mapInArrow(
        _runs(min_words, over_blank), f"doc_id {key}, run bigint, a int, b int")
    # A table of its own, so that the join below has shuffles in which a hot run can be split.
    shared = shared_table(runs.groupBy("run").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
    ).filter("first < last").select("run", "first"), "shared-runs")
    # Of each pair only the stretches that the later document shares with this holder travel.
    spans = runs.join(shared, "run").groupBy("doc_id", "first").agg(
        F.collect_set(F.struct("a", "b")).alias("spans")).select(
        "doc_id", "first", "spans.a", "spans.b")
    held = shared_table(
        spans.join(lines, "doc_id").select("doc_id", "first", "at", "line", "words", "a", "b")
        .mapInArrow(_covered(over_blank), f"doc_id {key}, first {key}, pos array<int>, "
                    "at array<int>, line array<bigint>, words array<int>").distinct(), "held")
    pairs = held.filter("first < doc_id").select(
        "doc_id", "first", F.col("pos").alias("l_pos"), F.col("at").alias("l_at"),
        F.col("line").alias("l_line"), F.col("words").alias("l_words"))
    kept = held.filter("first = doc_id").select(
        "first", F.col("pos").alias("k_pos"), F.col("line").alias("k_line"))
    gone = pairs.join(kept, "first").drop("first").mapInArrow(
        _aligned(min_words), f"doc_id {key}, gone array<int>")
    return gone.groupBy("doc_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def drop_repeated_lines(docs: DataFrame, min_words: int = 30,
                        over_blank: bool = False) -> DataFrame:
    """``docs`` with the texts shortened, and n_lines and n_removed.

    From each document all runs of lines of ``min_words`` words or more are deleted that an
    earlier one (smaller doc_id) has too; the first holder keeps every line. A line without
    words ends a run unless ``over_blank``; then paragraphs count together. All
    columns of ``docs`` stay; n_lines and n_removed replace columns of those names. A
    document may end up with an empty text. Null or empty texts, and rows without doc_id,
    stay as they are; repeated rows of one doc_id are the same document and are never aligned
    with each other. An empty table gives an empty result.
    """
    held, back = hold(docs, "doc_id", "text")
    gone = shared_table(repeated_lines(held, min_words, over_blank), "gone-lines").withColumnRenamed(
        "gone", "__gone")
    # The same plan at every size: documents meet their deletions by a merge join.
    joined = held.join(gone.hint("merge"), "doc_id", "left")
    lines = _lines()
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(
        F.transform(left, lambda i: F.element_at(F.col("__lines"), i + 1)), "\n"))
    cut = joined.withColumn("__lines", F.when(F.col("__gone").isNotNull(), lines)).withColumns({
        "n_lines": F.size(lines), "n_removed": F.coalesce(F.size("__gone"), F.lit(0)),
        "text": text})
    return back(cut, "n_lines", "n_removed")
