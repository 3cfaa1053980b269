from __future__ import annotations

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from geopanel.llm import lmscore, ppm


class SlowPPM:
    """Method C with exclusion over plain dictionaries, no node left out."""

    def __init__(self, bodies, order):
        self.order, self.after = order, {}
        for body in bodies:
            data = bytes([255]) * order + body.lower() + bytes([255])
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.after.setdefault(data[i - k:i], Counter())[data[i]] += 1

    def probability(self, context, byte):
        out, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            counts = self.after.get(context[len(context) - k:])
            if counts is None:
                continue
            left = {b: n for b, n in counts.items() if b not in excluded}
            total = sum(left.values()) + len(left)
            if byte in left:
                return out * left[byte] / total
            if total:
                out *= len(left) / total
            excluded |= set(counts)
        return out / (256 - len(excluded))

    def score(self, body):
        data = bytes([255]) * self.order + body.lower() + bytes([255])
        return sum(math.log10(self.probability(data[i - self.order:i], data[i]))
                   for i in range(self.order, len(data)))


def trie(bodies, order, least=1):
    data, places, _ = ppm.coded(bodies, order)
    full = Counter(ppm.keys(data, places, order).tolist())
    nodes, contexts = {}, {}
    for length in range(order + 1, 0, -1):
        at = Counter()
        for key, n in full.items():
            at[key & ((1 << (8 * length)) - 1)] += n
        floor = least if length > 3 else 1
        kept = {k: n for k, n in at.items() if n >= floor}
        nodes |= {k | ((length + 1) << ppm.TAG): n for k, n in kept.items()}
        for k, n in at.items():
            if any(x >> 8 == k >> 8 for x in kept):
                c = contexts.setdefault((k >> 8) | (length << ppm.TAG), [0, 0])
                c[0] += n
                c[1] += 1

    def arrays(table, *columns):
        return [np.array(list(table), np.uint64), *[np.array(c, np.int64) for c in columns]]

    return ppm.Trie.build(
        *arrays(nodes, list(nodes.values())),
        *arrays(contexts, [c[0] for c in contexts.values()], [c[1] for c in contexts.values()]),
        order)


TRAIN = [b"the cat sat on the mat", b"the dog sat", b"", b"a cat and a dog", "é và".encode(),
         b"abcabcabd"]


@pytest.mark.parametrize("order", [2, 4, 5])
def test_same_as_plain_partial_matching(order):
    model, slow = trie(TRAIN, order), SlowPPM(TRAIN, order)
    texts = [*TRAIN, b"the bat", b"zzz", b"THE CAT", "ñandú".encode(), b"cab", bytes(range(200))]
    got = model.score(texts)
    assert np.allclose(got, [slow.score(t) for t in texts], rtol=1e-9)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_probabilities_add_up_to_one(least):
    model = trie(TRAIN * 2 + [b"the cab sat on a mat"], 4, least)
    for context in (b"the ", b"cat ", b"zzzz", b"\xff\xff\xff\xff", b"on t", b"abca"):
        base = int.from_bytes(context, "big") << 8
        keys = np.array([base | b for b in range(256)], np.uint64)
        assert math.isclose(np.exp(model.logs(keys)).sum(), 1.0, rel_tol=1e-9)


def test_tables_and_counters():
    draw = np.random.default_rng(1)
    known = np.unique(draw.integers(0, 1 << 50, 5000).astype(np.uint64))
    table = ppm.Table(known)
    assert (table.find(known) == np.arange(known.size)).all()
    other = np.setdiff1d(draw.integers(0, 1 << 50, 5000).astype(np.uint64), known)
    assert (table.find(other) == -1).all()
    counter, total = ppm.KeyCounter(limit=50), Counter()
    seen = draw.integers(0, 90, (30, 40)).astype(np.uint64)
    for part in [*seen, None]:
        full = counter.rest() if part is None else counter.add(part)
        for k, n in zip(*full, strict=True) if full else ():
            total[int(k)] += int(n)
    assert total == Counter(seen.ravel().tolist())


def test_words_are_looked_up_together():
    """Words are hashed and summed text by text without a table of the words met."""
    bodies = [b"b a a c", b"", b"a \xc3\xa9"]
    found = [Counter(b.split()) for b in bodies]
    words = sorted(set().union(*found))
    assert lmscore.word_keys(words, len(words)).tolist() == [*map(lmscore.word_key, words)]
    logs = lmscore.WordLogs(lmscore.word_keys([b"a", b"b"], 2), np.array([-1.0, -0.25]))
    known, base, others, keys, times = logs.score(found)
    assert (known.tolist(), base.tolist(), others.tolist()) == ([3, 0, 1], [-2.25, 0, -1], [1, 0, 1])
    assert keys.tolist() == [lmscore.word_key(w) for w in (b"c", "\u00e9".encode())]
    assert times.tolist() == [1, 1]
    assert [x.size for x in lmscore.WordLogs(*(x[:0] for x in (keys, base))).score(found)] == [
        3, 3, 3, 5, 5]


def slow_base(rows):
    tokens = {d: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")),
                  None] for d, t in rows}
    held = {d: crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    return {d: (held[d], len(ws), sum(counts[w] > 0 for w in ws), total, sum(
        math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws))
        for d, ws in tokens.items()}


@pytest.mark.parametrize("head", [1 << 17, 20])
def test_query_columns(documents, monkeypatch, head):
    monkeypatch.setattr(lmscore, "HEAD", head)
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choice(["The", "cat", "sat", "été", f"n{draw.randint(0, 300)}"])
                         for _ in range(draw.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "\x1c  a\x0bb")]
    found = {r.doc_id: r for r in lmscore.score_documents(documents(rows)).collect()}
    slow = SlowPPM([(t or "").encode() for d, t in rows if crc32(str(d).encode()) % 5 != 1], ppm.ORDER)
    for d, (held, n, known, total, base) in slow_base(rows).items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    for d, t in rows[::15] + rows[-3:]:
        assert math.isclose(found[d].score, slow.score((t or "").encode()), rel_tol=1e-6)


def test_held_out_texts_cost_less_than_by_their_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sums = lmscore.score_documents(docs).filter("held_out").selectExpr(
        "sum(score) AS score", "sum(base_score) AS base", "avg(bits_per_byte) AS bits").first()
    assert sums.score > sums.base and sums.bits < 3


def test_odd_rows(odd):
    found = lmscore.score_documents(odd).collect()
    assert len(found) == odd.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    assert lmscore.score_documents(odd.limit(0)).collect() == []


def test_rare_contexts_count_in_large_corpora(documents):
    """More than 2 MB of training text, and contexts that occur once in it."""
    many = "the cat sat on the mat and the dog sat on the cat " * 1000
    odd_ones = [f"{word} quartz{i} jumbled vexing fjord" for i, word in enumerate("xyz" * 4)]
    rows = [*((i, many) for i in range(60)), *((100 + i, t) for i, t in enumerate(odd_ones))]
    train = [t.encode() for d, t in rows if crc32(str(d).encode()) % 5 != 1]
    assert sum(map(len, train)) > 1 << 21
    slow = SlowPPM(train, ppm.ORDER)
    got = {r.doc_id: r for r in lmscore.score_documents(documents(rows)).collect()}
    for d, t in rows[60:]:
        assert math.isclose(got[d].score, slow.score(t.encode()), rel_tol=1e-9)
    assert {got[d].held_out for d, _ in rows[60:]} == {True, False}


@pytest.mark.parametrize("resolution", [1, 50])
def test_same_score_whatever_is_broadcast(documents, monkeypatch, resolution):
    monkeypatch.setattr(lmscore, "RESOLUTION", resolution)
    monkeypatch.setattr(lmscore, "PART", 40)
    texts = [t.decode() for t in TRAIN] * 3 + ["the bat", "zzz", "\u00f1and\u00fa", "cab"] * 2
    slow = SlowPPM([t.encode() for d, t in enumerate(texts)
                    if crc32(str(d).encode()) % 5 != 1], ppm.ORDER)
    for r in lmscore.score_documents(documents(list(enumerate(texts)))).collect():
        assert math.isclose(r.score, slow.score(texts[r.doc_id].encode()), rel_tol=1e-9)
