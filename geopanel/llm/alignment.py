"""Alignment of two tokenizations of the same texts by the ends of their tokens.

Both tokenizers spell a text in bytes. The ends of the tokens, added up, are the keys of one
dictionary per side, end to index; the keys that both have, sorted, cut both id lists into
groups that spell the same bytes. The two tokens that end together in a group are linked,
and how often an id pair is linked in the whole corpus tells which links are the usual ones.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import pick, shared_table

#: Pairs with at least one in this many links are looked up in every task, so at most as many.
FREQUENT = 1 << 18
#: Characters of the texts that are encoded together.
TOGETHER = 1 << 19
#: Links that a task counts, or looks up, in one go.
CHUNK = 1 << 19
#: Units whose alignment a worker remembers.
MEMORY = 200_000

#: New units that are aligned as one text.
SIDE = 256

#: How side B spells a blank.
BLANK = "\u2581"
#: What stands for a unit that has no blank before it, or blanks at its start, and its text.
NEXT_LINE, HEAD, COMMA, STOP = "\x01", "\x02", "\x03", "\x04"
MARKS = {NEXT_LINE: "\n", HEAD: " ", COMMA: ",", STOP: "."}
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_CUT = re.compile(r"(?<! ) (?=\S)")
# The sign first and what stands before it second: the search then goes from sign to sign.
_AFTER_WORD = {COMMA: re.compile(r",(?<=[^\W_²],) (?=\S)"),
               STOP: re.compile(r"\.(?<=[^\W_²]\.) (?=\S)")}
_NOT_CUT = re.compile(rf"[^{BLANK}]{BLANK}|\n|[^\W_²][,.]")


def spelled_bytes(token: str) -> bytes:
    """The bytes of an entry of a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    return bytes(_BYTE_OF[c] for c in token)


_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class ByteLevel:
    """Side A: a byte-level tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocabulary = self.model.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # Special tokens are not met, as their strings are ordinary text.
            self.bytes[i] = spelled_bytes(token) if all(c in _BYTE_OF for c in token) else b""

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Side B: a sentence piece model, which puts a blank before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(re.fullmatch("<0x(..)>", piece)[1], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes.append(b"")
            else:
                if _NOT_CUT.search(piece):
                    raise ValueError(f"a piece that goes on where units end: {piece!r}")
                self.bytes.append(piece.replace(BLANK, " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def end_index(ids: list[int], lengths: list[int]) -> dict[int, int]:
    """Byte offset at which a token ends -> number of tokens up to it."""
    return dict(zip(accumulate([lengths[i] for i in ids]), range(1, len(ids) + 1), strict=True))


def slices(a: dict[int, int], b: dict[int, int]) -> tuple[list[int], list[int]]:
    """Numbers of tokens of either side up to each end that both have, in order."""
    common = sorted(a.keys() & b.keys())
    return [a[end] for end in common], [b[end] for end in common]


def group_texts(
    a: list[int], b: list[int], cuts_a: list[int], cuts_b: list[int]
) -> list[str]:
    """``a1,a2|b1``, ``a3|b2,b3``: the ids of each group."""
    at, bt, out = 0, 0, []
    for i, j in zip(cuts_a, cuts_b, strict=True):
        if i == at + 1 and j == bt + 1:
            out.append(f"{a[at]}|{b[bt]}")
        else:
            out.append(f"{','.join(map(str, a[at:i]))}|{','.join(map(str, b[bt:j]))}")
        at, bt = i, j
    return out


class Aligner:
    """What ``keep`` makes of both tokenizations of a text's units and their groups.

    ``keep(a, b, cuts_a, cuts_b, ends)`` makes one value of each unit of a row of them;
    ``ends`` says how many ids of both sides and groups there are up to the unit's end.

    A text is cut where both sides end a token whatever stands around: before a blank that
    has no blank before it and a non-blank behind it, before a line end between two non-blanks,
    and between a letter or digit (but not "²") and a comma or full stop before such a blank.
    Units come again, so what ``keep`` made of them is remembered; of two halves of the memory
    the older one goes when the younger is full. New units are aligned many in a row, as one
    text. A unit that a side does not spell in full has None.
    """

    def __init__(self, first: str, second: str, keep: Callable):
        self.a, self.b, self.keep = ByteLevel(first), Pieces(second), keep
        self.len_a = [len(x) for x in self.a.bytes]
        self.len_b = [len(x) for x in self.b.bytes]
        self.known: dict[str, object] = {}
        self.old: dict[str, object] = {}
        #: Whether any unit has None.
        self.failed = False

    def _units(self, text: str, new: set[str]) -> list[str]:
        """The units of a text; those that are not known are added to ``new``."""
        if any(mark in text for mark in MARKS):
            units = [HEAD + text]
        else:
            marked = _LINE.sub(f" {NEXT_LINE}", text)
            marked = _AFTER_WORD[COMMA].sub(f" {COMMA} ", marked)
            marked = _AFTER_WORD[STOP].sub(f" {STOP} ", marked)
            units = marked.split(" ")
            fresh = set(units).difference(self.known)
            if all(u and not u[0].isspace() for u in fresh):
                new |= fresh
                return units
            # Some blank is followed by another blank, or by nothing, or begins the text.
            head, *units = _CUT.split(" " + marked)
            units = [HEAD + head[1:], *units] if head else units
        new |= set(units).difference(self.known)
        return units

    def _learn(self, units: list[str]) -> None:
        """Units that end in a non-blank in rows of ``SIDE``, the others one by one."""
        row: list[str] = []
        rows = []
        for unit in units:
            if unit[0] in (HEAD, COMMA, STOP) or unit[-1].isspace():
                rows.append([unit])
            else:
                row.append(unit)
                if len(row) == SIDE:
                    rows.append(row)
                    row = []
        self._align_rows([*rows, row] if row else rows)

    def _align_rows(self, rows: list[list[str]]) -> None:
        spelled = [[MARKS[u[0]] + u[1:] if u[0] in MARKS else " " + u for u in row]
                   for row in rows]
        texts = ["".join(row) for row in spelled]
        # Side B begins every text with a blank; behind a line end nothing joins it.
        first = [t[0] for t in texts]
        bare = [t[1:] if c == " " else t if c == "\n" else "\n" + t
                for t, c in zip(texts, first, strict=True)]
        extra = [0 if c == " " else 1 if c == "\n" else 2 for c in first]
        failed = []
        for row, parts, text, a, b, n in zip(
                rows, spelled, texts, self.a.encode(texts), self.b.encode(bare), extra,
                strict=True):
            if not self._align_row(row, parts, text.encode(), a, b[n:]):
                failed.append(row)
        for row in failed:
            if len(row) == 1:
                self.known[row[0]] = None
                self.failed = True
            else:
                self._align_rows([[u] for u in row])

    def _align_row(self, row, parts, body: bytes, a: list[int], b: list[int]) -> bool:
        spell_a, spell_b = self.a.bytes, self.b.bytes
        if b"".join([spell_a[i] for i in a]) != body or b"".join([spell_b[i] for i in b]) != body:
            return False
        index_a, index_b = end_index(a, self.len_a), end_index(b, self.len_b)
        cuts_a, cuts_b = slices(index_a, index_b)
        # Both sides end a token where a unit ends.
        ends = list(accumulate(
            map(len, parts if len(body) == sum(map(len, parts)) else [p.encode() for p in parts])))
        nth = dict(zip(cuts_a, range(1, len(cuts_a) + 1), strict=True))
        to_a = [index_a[end] for end in ends]
        to_b = [index_b[end] for end in ends]
        kept = self.keep(a, b, cuts_a, cuts_b, zip(to_a, to_b, [nth[i] for i in to_a], strict=True))
        self.known.update(zip(row, kept, strict=True))
        return True

    def __call__(self, texts: list[str | None]) -> list[list]:
        """Per text what its units have; nothing if it has no tokens."""
        # Nothing here refers back to itself, so the memory need not be searched for that.
        searching = gc.isenabled()
        gc.disable()
        try:
            return self._found(texts)
        finally:
            if searching:
                gc.enable()

    def _found(self, texts: list[str | None]) -> list[list]:
        if len(self.known) > MEMORY // 2:
            self.old, self.known = self.known, {}
        new: set[str] = set()
        split = [self._units(t, new) if t else [] for t in texts]
        again = new.intersection(self.old)
        self.known.update((u, self.old[u]) for u in again)
        if len(new) > len(again):
            self._learn(list(new.difference(again)))
        find = self.known.__getitem__
        found = [list(map(find, units)) for units in split]
        return [[] if None in units else units for units in found] if self.failed else found


_aligners: dict[tuple, Aligner] = {}


def aligner(first: str, second: str, keep: Callable) -> Aligner:
    key = (first, second, keep.__name__)
    if key not in _aligners:
        _aligners[key] = Aligner(first, second, keep)
    return _aligners[key]


def forget_aligners() -> None:
    """Give back the memory of this worker's aligners once the texts are aligned."""
    _aligners.clear()


def _each(docs: DataFrame, first: str, second: str, keep: Callable, rows: Callable,
          names: str) -> DataFrame:
    """doc_id and the columns that ``rows`` makes of what ``keep`` made of the units."""
    docs = pick(docs, "doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {names}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = aligner(first, second, keep)
        for batch in batches:
            begin, held, texts = 0, 0, []
            for at, text in enumerate(batch[1]):
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= TOGETHER or at + 1 == batch.num_rows:
                    columns = rows(of(texts))
                    yield pa.RecordBatch.from_arrays(
                        [batch[0].slice(begin, len(texts)), *columns.values()],
                        names=["doc_id", *columns])
                    begin, held, texts = at + 1, 0, []

    return docs.mapInArrow(run, schema)


def _lists(values: np.ndarray, sizes: list[int]) -> pa.ListArray:
    ends = np.cumsum([0, *sizes]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _whole(a, b, cuts_a, cuts_b, ends):
    at_a = at_b = at = 0
    out = []
    for to_a, to_b, to in ends:
        out.append((a[at_a:to_a], b[at_b:to_b], [i - at_a for i in cuts_a[at:to]],
                    [i - at_b for i in cuts_b[at:to]]))
        at_a, at_b, at = to_a, to_b, to
    return out


def _whole_rows(found: list[list]) -> dict[str, pa.Array]:
    out: tuple[list, ...] = ([], [], [], [])
    for units in found:
        lists: tuple[list, ...] = ([], [], [], [])
        for a, b, cuts_a, cuts_b in units:
            lists[2].extend(c + len(lists[0]) for c in cuts_a)
            lists[3].extend(c + len(lists[1]) for c in cuts_b)
            lists[0].extend(a)
            lists[1].extend(b)
        for column, values in zip(out, lists, strict=True):
            column.append(values)
    return {n: pa.array(c, pa.list_(pa.int32()))
            for n, c in zip(("a_ids", "b_ids", "a_cuts", "b_cuts"), out, strict=True)}


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, a_ids, b_ids, a_cuts, b_cuts: both tokenizations of each text and their groups.

    Group n holds the ids from cut n - 1 to cut n of either list. ``first`` is the path of a byte-level
    tokenizer file, ``second`` that of a sentence piece model, on every machine. Null and empty
    texts, and those that a side does not spell in full, have no ids. Repeated rows are
    documents of their own; extra columns are ignored.
    """
    return _each(docs, first, second, _whole, _whole_rows,
                 "a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>")


def _digest(a, b, cuts_a, cuts_b, ends):
    """Of each unit one row of bytes, as many are remembered: numbers of ids of both sides and of
    links, the links as 32-bit ids, the text of the groups with a semicolon behind each."""
    links = array("i", chain.from_iterable(zip(
        [a[i - 1] for i in cuts_a], [b[j - 1] for j in cuts_b], strict=True))).tobytes()
    groups = group_texts(a, b, cuts_a, cuts_b)
    text = (";".join(groups) + ";").encode()
    text_ends = [0, *accumulate([len(g) + 1 for g in groups])]
    at_a = at_b = at = 0
    out = []
    for to_a, to_b, to in ends:
        out.append(_HEADER(to_a - at_a, to_b - at_b, to - at) + links[8 * at:8 * to]
                   + text[text_ends[at]:text_ends[to]])
        at_a, at_b, at = to_a, to_b, to
    return out


_HEADER = struct.Struct("=iii").pack


def _digest_rows(found: list[list[bytes]]) -> dict[str, pa.Array]:
    units = list(chain.from_iterable(found))
    data = np.frombuffer(b"".join(units), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
    starts = np.append(0, ends)[:len(units)]
    header = np.frombuffer(b"".join([u[:12] for u in units]), "i4").reshape(-1, 3)
    texts = starts + 12 + 8 * header[:, 2].astype(np.int64)
    # Bytes of links are of kind 1, those of text 2.
    kind = np.zeros(data.size + 1, np.int8)
    kind[starts + 12] += 1
    kind[texts] += 1
    kind[ends] -= 2
    kind = np.cumsum(kind, dtype=np.int8, out=kind)[:-1]
    pairs = data[kind == 1].view("i4").reshape(-1, 2)
    text = data[kind == 2].tobytes()
    del data, kind
    unit_ends = np.cumsum([0, *map(len, found)])
    n_a, n_b, n_links = (_per_row(header[:, i], unit_ends) for i in range(3))
    text_ends = np.append(0, np.cumsum(_per_row(ends - texts, unit_ends))).tolist()
    # No semicolon stands behind the last group.
    digests = [hashlib.sha256(text[at:to - 1]).hexdigest() if to > at else ""
               for at, to in zip(text_ends, text_ends[1:], strict=False)]
    sizes = n_links.tolist()
    return {
        "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_links),
        "groups_sha256": pa.array(digests, pa.string()),
        "link_a": _lists(np.ascontiguousarray(pairs[:, 0]), sizes),
        "link_b": _lists(np.ascontiguousarray(pairs[:, 1]), sizes)}


def _links(docs: DataFrame, first: str, second: str) -> DataFrame:
    """The digest of every document's alignment, and its links as two lists of ids."""
    return _each(docs, first, second, _digest, _digest_rows,
                 "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
                 "link_a array<int>, link_b array<int>")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, cut so that no part has many more than ``CHUNK`` links."""
    for batch in batches:
        ends = np.cumsum(batch["link_a"].value_lengths().to_numpy(zero_copy_only=False))
        number = ends // CHUNK
        starts = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if ends.size else []
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def _codes(a: pa.Array, b: pa.Array) -> np.ndarray:
    return (a.flatten().to_numpy(zero_copy_only=False).astype(np.int64) << 32) | \
        b.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(links: DataFrame) -> DataFrame:
    """pair (id of A and of B in 64 bits), n, best: how often an id pair is linked in all rows.

    best says that no pair with the same id of B is linked more often. Counted in every task
    first, ``CHUNK`` links at a time, so a common pair is one row per chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_aligners()
        held, size = [], 0
        for batch in _parts(batches):
            held.append(_codes(batch["link_a"], batch["link_b"]))
            size += held[-1].size
            if size >= CHUNK:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    def counted(held):
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))],
                                          names=["pair", "n"])

    counts = links.select("link_a", "link_b").mapInArrow(run, "pair bigint, n bigint").groupBy(
        "pair").agg(F.sum("n").alias("n"))
    counts = shared_table(counts, "pair-counts")
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return shared_table(
        counts.withColumn("b", b).join(most, "b").select(
            "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def alignment_digest(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document.

    A link is a pair of tokens whose bytes end together, the last ones of a group. An id pair
    counts how many links of all documents hold it; n_best are links whose count is the highest that
    their id of B has (ties too), count_sum is the sum of the counts. Texts as in ``align``;
    a document without tokens has zeros and an empty digest. No rows give no rows.

    Pairs that make up at least one in ``FREQUENT`` links (so at most that many pairs, in every
    corpus) are looked up where the links are; the other links are joined with the counts.
    """
    links = _links(docs, first, second).withColumn("row", F.monotonically_increasing_id())
    links = shared_table(links, "links")
    pairs = pair_counts(links)
    total = links.agg(F.sum("n_groups")).first()[0] or 0
    floor = -(-total // FREQUENT)
    known = pairs.filter(F.col("n") >= floor).toArrow().sort_by("pair")
    table = links.sparkSession.sparkContext.broadcast(
        tuple(known[c].combine_chunks().to_numpy(zero_copy_only=False)
              for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_aligners()
        pair, n, best = table.value
        for batch in _parts(batches):
            a, b = batch.column("link_a"), batch.column("link_b")
            codes = _codes(a, b)
            ends = np.cumsum(np.append(0, a.value_lengths().to_numpy(zero_copy_only=False)))
            at = np.searchsorted(pair, codes)
            at[at == pair.size] = 0
            found = pair[at] == codes if pair.size else np.zeros(codes.size, bool)
            sums = _per_row(np.where(found, n[at], 0) if pair.size else codes * 0, ends)
            bests = _per_row(np.where(found, best[at], False) if pair.size else codes * 0, ends)
            rest = _per_row(~found, ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(bests), pa.array(sums),
                 pa.ListArray.from_arrays(
                     pa.array(np.append(0, np.cumsum(rest)).astype(np.int32)),
                     pa.array(codes[~found]))],
                names=["row", "bests", "sums", "rest"])

    kept = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    looked = shared_table(
        links.select("row", "link_a", "link_b").mapInArrow(
            run, "row bigint, bests bigint, sums bigint, rest array<bigint>"), "looked-up")
    # Pairs below the floor, of which each occurs less often than the floor says.
    rare = looked.select("row", F.explode("rest").alias("pair")).join(
        pairs.filter(F.col("n") < floor), "pair").select(
        "row", F.col("best").cast("bigint").alias("bests"), F.col("n").alias("sums"))
    totals = looked.select("row", "bests", "sums").unionAll(rare).groupBy("row").agg(
        F.sum("bests").alias("n_best"), F.sum("sums").alias("count_sum"))
    return links.select("row", *kept).join(totals, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best",
        "count_sum", "groups_sha256")


def _per_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values.astype(np.int64)))
    return sums[ends[1:]] - sums[ends[:-1]]
