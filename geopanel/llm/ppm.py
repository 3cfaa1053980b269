"""Prediction by partial matching: a byte-context trie as vectorised tables.

A context of ``order`` bytes predicts the next byte. If that byte never followed the context,
an escape leads to the next shorter context, in which the bytes that followed the longer one
are excluded; in the end any byte is as likely as any other that is left. Escapes are
estimated by the number of different bytes seen (method C). Every text starts behind
``order`` marks and ends with one, a byte that UTF-8 doesn't use.

The trie is fixed once it is trained, so what an escape from a context costs, given what it
excludes, is one number per context, and scoring is one table look-up for most bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

ORDER = 5
MARK = 0xFF
#: Bytes handled at a time.
CHUNK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The length of a key stands above its bytes.
TAG = 48


def _clean(body: bytes) -> bytes:
    return body.lower().replace(b"\xff", b"\xfe")


def coded(bodies: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with marks, places that are coded, first of these of each text)."""
    mark = bytes([MARK]) * order
    parts = [_clean(b) for b in bodies]
    data = np.frombuffer(mark + mark.join(parts) + mark, np.uint8)
    size = np.array([len(p) for p in parts], np.int64)
    start = order + np.cumsum(np.r_[0, size[:-1] + order])
    live = np.zeros(data.size, bool)
    live[order:] = True
    for i in range(1, order):
        live[np.minimum(start + size + i, data.size - 1)] = False
    if order > 1:
        live[data.size - order + 1:] = False
    places = np.flatnonzero(live)
    return data, places, np.cumsum(np.r_[0, size[:-1] + 1])


def keys(data: np.ndarray, places: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The ``order`` bytes before every place and its own, as one number."""
    wide = data.astype(np.uint64)
    n = data.size - order
    out = wide[:n]
    for i in range(1, order + 1):
        out = (out << np.uint64(8)) | wide[i:n + i]
    return out[places - order]


def batches_of(bodies: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes."""
    begin, held = 0, 0
    for i, body in enumerate(bodies):
        held += len(body) + ORDER
        if held >= limit:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(bodies):
        yield begin, len(bodies)


class KeyCounter:
    """Counts of keys in bounded memory: full tables are handed on."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        self.parts.append(np.unique(found, return_counts=True))
        self.held += self.parts[-1][0].size
        if self.held > self.limit:
            table = self._merged()
            if table[0].size > self.limit // 2:
                self.parts, self.held = [], 0
                return table
            self.parts, self.held = [table], table[0].size
        return None

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        both, back = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        total = np.bincount(back, np.concatenate([n for _, n in self.parts]), both.size)
        return both, total.astype(np.int64)

    def rest(self) -> tuple[np.ndarray, np.ndarray] | None:
        return self._merged() if self.parts else None


class Table:
    """Numbers of known keys by open addressing, looked up for many keys at once."""

    def __init__(self, known: np.ndarray):
        self.bits = max(4, int(2 * known.size).bit_length())
        self.key = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.number = np.zeros(1 << self.bits, np.int32)
        left, slot = np.arange(known.size), self._slot(known)
        while left.size:
            # Of those that want a free slot one gets it, the others try the next.
            free = self.key[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.number[slot[free]] = left[free]
            won = free & (self.number[slot] == left)
            self.key[slot[won]] = known[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, found: np.ndarray) -> np.ndarray:
        return ((found * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, found: np.ndarray) -> np.ndarray:
        """The number of every key, -1 if it is not known."""
        slot = self._slot(found)
        there = self.key[slot]
        out = np.where(there == found, self.number[slot], -1)
        open_ = np.flatnonzero((there != found) & (there != np.uint64(0xFFFFFFFFFFFFFFFF)))
        slot = slot[open_]
        while open_.size:
            slot = (slot + 1) & ((1 << self.bits) - 1)
            there, want = self.key[slot], found[open_]
            hit = there == want
            out[open_[hit]] = self.number[slot[hit]]
            on = ~hit & (there != np.uint64(0xFFFFFFFFFFFFFFFF))
            open_, slot = open_[on], slot[on]
        return out


def tagged(key: np.ndarray, length: int) -> np.ndarray:
    """The last ``length`` bytes of keys, told apart by their length."""
    mask = np.uint64((1 << (8 * length)) - 1)
    return (key & mask) | (np.uint64(length + 1) << np.uint64(TAG))


@dataclass
class Trie:
    """Nodes (context and byte) with logarithms of counts; contexts with costs of escaping.

    For a context reached first (not by an escape): ``total`` is the logarithm of what its
    counts are divided by, ``leave`` that of its escape. For the step to its suffix, with the
    bytes of this context excluded there, ``down_total`` and ``down_leave`` are the same.
    """

    order: int
    nodes: Table
    count: np.ndarray
    contexts: Table
    total: np.ndarray
    leave: np.ndarray
    down_total: np.ndarray
    down_leave: np.ndarray
    left: int
    #: Of each node the logarithm of its probability in its own context, on first use.
    _first: np.ndarray | None = None

    @classmethod
    def build(cls, node_key: np.ndarray, node_n: np.ndarray, context_key: np.ndarray,
              context_n: np.ndarray, context_kinds: np.ndarray, order: int = ORDER) -> Trie:
        """From tagged keys with counts. Contexts bring all that was counted in them: their
        total and number of different bytes, of which the nodes may be a part; what is not
        among the nodes counts as escapes."""
        nodes, contexts = Table(node_key), Table(context_key)
        length = (node_key >> np.uint64(TAG)).astype(np.int64) - 1
        bytes_ = node_key & np.uint64((1 << TAG) - 1)
        # A node of length k is a byte behind a context of length k - 1.
        parent = np.empty(node_key.size, np.int64)
        above = np.full(node_key.size, 0.0)
        for k in range(1, order + 2):
            at = np.flatnonzero(length == k)
            parent[at] = contexts.find(tagged(bytes_[at] >> np.uint64(8), k - 1))
            if k > 1:
                suffix = nodes.find(tagged(bytes_[at], k - 1))
                above[at] = np.where(suffix >= 0, node_n[suffix], 0)
        n = context_key.size
        kept = np.bincount(parent, node_n, n)
        kinds = np.bincount(parent, minlength=n)
        taken = np.bincount(parent, above, n)
        ctx_length = (context_key >> np.uint64(TAG)).astype(np.int64) - 1
        ctx_bytes = context_key & np.uint64((1 << TAG) - 1)
        suffix = np.full(n, -1, np.int64)
        for k in range(1, order + 1):
            at = np.flatnonzero(ctx_length == k)
            suffix[at] = contexts.find(tagged(ctx_bytes[at], k - 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            total = np.log(context_n + context_kinds)
            leave = np.log(context_n - kept + context_kinds)
            # What is left in the suffix once the bytes of this context are excluded.
            rest = context_n[suffix] - taken
            new = np.maximum(context_kinds[suffix] - kinds, 0)
            down_total = np.log(rest + new)
            down_leave = np.log(context_n[suffix] - kept[suffix] + new)
        nothing = ~np.isfinite(down_total)
        down_total[nothing] = down_leave[nothing] = 0.0
        down_leave[~np.isfinite(down_leave)] = -50.0
        root = contexts.find(tagged(np.zeros(1, np.uint64), 0))[0]
        left = 256 - int(kinds[root]) if root >= 0 else 256
        return cls(order, nodes, np.log(node_n), contexts, total, leave, down_total, down_leave,
                   left)

    def logs(self, key: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of the last byte of each key."""
        k = self.order
        out = np.zeros(key.size)
        node = self.nodes.find(tagged(key, k + 1))
        hit = node >= 0
        parent = key >> np.uint64(8)
        if self._first is None:
            self._first = self._direct()
        out[hit] = self._first[node[hit]]
        at = np.flatnonzero(~hit)
        # The longest known context of every other place.
        context, level = np.full(at.size, -1), np.zeros(at.size, np.int64)
        todo = np.arange(at.size)
        for m in range(k, -1, -1):
            found = self.contexts.find(tagged(parent[at[todo]], m))
            context[todo], level[todo] = found, m
            todo = todo[found < 0]
            if not todo.size:
                break
        acc = np.zeros(at.size)
        came = np.full(at.size, -1)
        done = np.zeros(at.size, bool)
        if todo.size:
            acc[todo], done[todo] = -np.log(256), True
        for m in range(k, -1, -1):
            now = np.flatnonzero((level >= m) & ~done)
            if not now.size:
                continue
            first = level[now] == m
            where = np.where(first, context[now], came[now])
            total = np.where(first, self.total[where], self.down_total[where])
            leave = np.where(first, self.leave[where], self.down_leave[where])
            node = self.nodes.find(tagged(key[at[now]], m + 1))
            hit = node >= 0
            acc[now[hit]] += self.count[node[hit]] - total[hit]
            done[now[hit]] = True
            miss = now[~hit]
            acc[miss] += leave[~hit] - total[~hit]
            if m:
                # The context at this level, whose bytes are excluded below.
                came[miss] = self.contexts.find(tagged(parent[at[miss]], m))
            else:
                acc[miss] -= np.log(max(1, self.left))
        out[at] = acc
        return out

    def _direct(self) -> np.ndarray:
        used = np.flatnonzero(self.nodes.key != np.uint64(0xFFFFFFFFFFFFFFFF))
        key, number = self.nodes.key[used], self.nodes.number[used]
        out = np.empty(self.count.size)
        length = (key >> np.uint64(TAG)).astype(np.int64) - 1
        for m in range(1, self.order + 2):
            at = np.flatnonzero(length == m)
            body = key[at] & np.uint64((1 << TAG) - 1)
            context = self.contexts.find(tagged(body >> np.uint64(8), m - 1))
            out[number[at]] = self.count[number[at]] - self.total[context]
        return out

    def score(self, bodies: list[bytes]) -> np.ndarray:
        """log10 probability of every text, its end included."""
        out = np.zeros(len(bodies))
        for a, b in batches_of(bodies):
            data, places, first = coded(bodies[a:b], self.order)
            out[a:b] = np.add.reduceat(self.logs(keys(data, places, self.order)), first)
        return out / np.log(10)


class Head:
    """Logarithms of the probability of keys in their own context, for frequent keys."""

    def __init__(self, key: np.ndarray, log: np.ndarray, order: int = ORDER):
        self.nodes, self.log, self.order = Table(key), log, order

    def score(self, bodies: list[bytes]) -> tuple[np.ndarray, ...]:
        """(sum of the known logarithms of each text, and how many other keys it has; these
        keys, text by text, and how often each occurs there)."""
        out, more = np.zeros(len(bodies)), np.zeros(len(bodies), np.int64)
        rare, times = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        # The number of a text stands above its keys.
        for begin in range(0, len(bodies), 1 << 16):
            for a, b in batches_of(bodies[begin:begin + (1 << 16)]):
                a, b = begin + a, begin + b
                data, places, first = coded(bodies[a:b], self.order)
                key = keys(data, places, self.order)
                node = self.nodes.find(key)
                hit = node >= 0
                log = np.zeros(key.size)
                log[hit] = self.log[node[hit]]
                out[a:b] = np.add.reduceat(log, first)
                owner = np.repeat(np.arange(b - a, dtype=np.uint64),
                                  np.diff(np.r_[first, key.size]))
                found, n = np.unique((owner[~hit] << np.uint64(TAG)) | key[~hit],
                                     return_counts=True)
                more[a:b] = np.bincount((found >> np.uint64(TAG)).astype(np.int64),
                                        minlength=b - a)
                rare.append(found & np.uint64((1 << TAG) - 1))
                times.append(n)
        return out, more, np.concatenate(rare), np.concatenate(times)


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys, sums, numbers of rows)."""
    found, back = np.unique(key, return_inverse=True)
    return (found, np.bincount(back, n, found.size).astype(np.int64),
            np.bincount(back, minlength=found.size))


def levels(key: np.ndarray, n: np.ndarray, lengths: range) -> list[np.ndarray]:
    """Tagged node keys, counts; tagged context keys, counts, kinds, of nodes of ``lengths``."""
    nodes, contexts = [], []
    for length in lengths:
        at, total, _ = _summed(key & np.uint64((1 << (8 * length)) - 1), n)
        nodes.append((at | np.uint64((length + 1) << TAG), total))
        context, total, kinds = _summed(at >> np.uint64(8), total)
        contexts.append((context | np.uint64(length << TAG), total, kinds))
    return [np.concatenate(c) for c in [*zip(*nodes, strict=True), *zip(*contexts, strict=True)]]
