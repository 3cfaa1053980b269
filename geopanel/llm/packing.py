"""Packing token sequences by best-fit decreasing."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import pick, shared_table

#: Pieces that one task packs together; more pieces make more groups.
GROUP = 8192
#: Units whose ids a worker remembers.
MEMORY = 500_000
#: New units encoded in one go.
SIDE = 256
#: Characters of the texts that are encoded together.
TOGETHER = 1 << 21

_INNER = re.compile(r" (?=\S)")
# The sign first and what stands before it second: the search then goes from sign to sign.
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_AFTER_WORD = {c: re.compile(rf"{c}(?<=[^\W_]{c}) (?=\S)") for c in (",", r"\.")}
#: What stands for a unit that has no blank before it, and its text.
NEXT_LINE, COMMA, STOP = "\x01", "\x02", "\x03"
MARKS = {NEXT_LINE: "\n", COMMA: ",", STOP: "."}
#: How the vocabulary spells a blank and a line end.
BLANK, LINE_END = "\u0120", "\u010a"


class UnitEncoder:
    """Token ids of whole texts, as little-endian 32-bit bytes, unit by unit.

    The byte-level splitter starts a new piece at every blank that a non-blank follows, at
    a line end between two non-blanks and behind it, and between a letter or digit and a
    comma or full stop. So a text may be cut there and its units encoded alone; units are
    remembered, those in use when the memory is full for longer. New units of many texts
    are encoded side by side: only the first token of a unit begins with its separator.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocabulary = self.model.get_vocab()
        self.begins = {}
        for separator, spelled in ((" ", BLANK), ("\n", LINE_END)):
            flags = np.zeros(max(vocabulary.values()) + 1, bool)
            flags[[i for t, i in vocabulary.items() if t.startswith(spelled)]] = True
            self.begins[separator] = flags
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _side_by_side(self, units: list[str], bodies: list[str], separator: str) -> None:
        """Units whose text is the separator and a body that does not hold it."""
        for_all = [(units[at:at + SIDE], separator + separator.join(bodies[at:at + SIDE]))
                   for at in range(0, len(units), SIDE)]
        flags = self.begins[separator]
        for (row, _), ids in zip(for_all, self._ids([t for _, t in for_all]), strict=True):
            ends = [*np.flatnonzero(flags[ids]).tolist(), ids.size]
            body = ids.tobytes()
            self.known.update(zip(
                row, [body[4 * i:4 * j] for i, j in zip(ends, ends[1:], strict=False)],
                strict=True))

    def _learn(self, units: list[str]) -> None:
        plain, lines, alone = [], [], []
        for u in units:
            if u[0] == NEXT_LINE and "\n" not in u:
                lines.append(u)
            elif " " in u or u[0] in MARKS:
                alone.append(u)
            else:
                plain.append(u)
        self._side_by_side(plain, plain, " ")
        self._side_by_side(lines, [u[1:] for u in lines], "\n")
        texts = [MARKS.get(u[0], f" {u[0]}") + u[1:] for u in alone]
        self.known.update(zip(alone, (x.tobytes() for x in self._ids(texts)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        heads, split, new = [], [], []
        for text in texts:
            if any(mark in text for mark in MARKS):
                # A text that holds the marks themselves is one unit.
                head, units, missing = text, [], set()
            else:
                marked = _LINE.sub(f" {NEXT_LINE}", text)
                marked = _AFTER_WORD[","].sub(f" {COMMA} ", marked)
                marked = _AFTER_WORD[r"\."].sub(f" {STOP} ", marked)
                head, *units = marked.split(" ")
                missing = set(units).difference(self.known)
                if any(not u or u[0].isspace() for u in missing):
                    # Some blank is followed by another, or by nothing.
                    head, *units = _INNER.split(marked)
                    missing = set(units).difference(self.known)
            heads.append(head)
            split.append(units)
            new += missing
        new = list(set(new))
        if len(self.known) + len(new) > MEMORY:
            used = set().union(*split).intersection(self.known)
            self.known = {u: self.known[u] for u in used}
        self._learn(new)
        find = self.known.__getitem__
        return [head.tobytes() + b"".join(map(find, units))
                for head, units in zip(self._ids(heads), split, strict=True)]


_encoders: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048,
                 end_id: int = 1) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids: every document cut into full windows and a rest.

    ids holds little-endian 32-bit token ids; the document ends with ``end_id``. A null or
    empty text has that one token. Repeated rows are documents of their own. Extra columns
    are ignored. ``tokenizer`` is the path of a byte-level tokenizer file on every machine.
    """
    rows = pick(docs, "doc_id", "text")
    key = rows.schema["doc_id"].dataType
    schema = (f"doc_id {key.simpleString()}, start bigint, length bigint, doc_tokens bigint, "
              "ids binary")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            begin, held, texts = 0, 0, []
            for at, text in enumerate(batch[1]):
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= TOGETHER or at + 1 == batch.num_rows:
                    yield rows_of(batch[0], begin, [x + end for x in encode(texts)])
                    begin, held, texts = at + 1, 0, []

    def rows_of(keys, begin, encoded):
        out = []
        for at, ids in enumerate(encoded, begin):
            n = len(ids) // 4
            for start in range(0, n, capacity):
                part = ids[4 * start:4 * (start + capacity)]
                out.append((at, start, len(part) // 4, n, part))
        at, start, length, n, parts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([
            keys.take(pa.array(at)), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
            pa.array(n, pa.int64()), pa.array(parts, pa.binary()),
        ], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return rows.mapInArrow(run, schema)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of which leaves hold any."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, window: int, remaining: int) -> None:
        self.held[remaining].append(window)
        node = remaining + self.size
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest window with ``need`` left, and what it has left; None if there is none."""
        node, tree = need + self.size, self.any
        while not tree[node]:
            # To the next subtree on the right.
            while node & 1:
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.size:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        remaining = node - self.size
        window = self.held[remaining].pop()
        if not self.held[remaining]:
            while node:
                tree[node] = node < self.size and (tree[2 * node] or tree[2 * node + 1])
                if tree[node]:
                    break
                node >>= 1
        return window, remaining


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(window, offset) of each length, given from the longest to the shortest."""
    open_windows, placed, used = OpenWindows(capacity), [], 0
    for length in lengths:
        found = open_windows.take(length)
        window, remaining = found or (used, capacity)
        used += found is None
        placed.append((window, capacity - remaining))
        if remaining > length:
            open_windows.put(window, remaining - length)
    return placed


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with sequence_id and offset; any further columns go along.

    Pieces are dealt at random into groups of about ``GROUP`` and every group is packed by
    itself, longest first, each piece into the tightest window that has room. A group
    leaves a few windows unfilled at most, so padding shrinks with the size of the input
    down to what a group of that size has. sequence_id is unique over all groups.
    """
    rows = shared_table(pieces, "pieces")
    groups = max(1, -(-rows.count() // GROUP))
    dealt = rows.withColumn(
        "__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    names = [f.name for f in rows.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        keys = [("length", "descending")] + [
            (n, "ascending") for n in ("doc_id", "start") if n in names]
        group = group.sort_by(keys)
        placed = best_fit_decreasing(group["length"].to_pylist(), capacity)
        window, offset = (np.array(x, np.int64) for x in zip(*placed, strict=True))
        number = group["__group"][0].as_py()
        out = group.select(names)
        out = out.append_column("sequence_id", pa.array((number << 32) | window))
        return out.append_column("offset", pa.array(offset))

    return dealt.groupBy("__group").applyInArrow(
        run, f"{schema}, sequence_id bigint, `offset` bigint")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048,
                   end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their ids and places; see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)


def packed_digest(docs: DataFrame, tokenizer: str, capacity: int = 2048,
                  end_id: int = 1) -> DataFrame:
    """The same with the checksum of each piece in place of its ids, which stay unshuffled."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)
