from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from geopanel.llm import packing
from geopanel.llm.queries import TOKENIZER

NASTY = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "x\n\ny z", "I'll  can't we're",
    "tab\there  and nbsp 　wide", "  lead", "trail  ", "é à ü", "漢字 テスト 1234 5",
    "<|endoftext|> x", "\x1c \x1d a \x1f b", "emoji 😀 👍🏽 z", "a\r\n b", "1,234.56 -- __init__ ...",
    "a ​ b", "\u0085 x \u0085y", "a, b, c.\nD. E,\n f", "x\x01y \x02 z", "1, 2. 3", "a.\nb.\n\nc,\td", "²., é. ñ, a",
]


def test_units_give_the_ids_of_the_whole_text():
    model = Tokenizer.from_file(TOKENIZER)
    model.encode_special_tokens = True
    draw = random.Random(1)
    parts = [c for t in NASTY for c in t] + [" ", "\n", "ab", "The", "'s", "  "] * 5
    texts = NASTY + ["".join(draw.choices(parts, k=40)) for _ in range(400)]
    encoder = packing.UnitEncoder(TOKENIZER)
    for begin in range(0, len(texts), 50):
        some = texts[begin:begin + 50]
        for text, found in zip(some, encoder.encode(some), strict=True):
            ids = np.frombuffer(found, "<u4").tolist()
            assert ids == model.encode(text, add_special_tokens=False).ids, repr(text)


def test_forgetting_units(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 3)
    encoder = packing.UnitEncoder(TOKENIZER)
    for text in ("a b c d e", "f g a b", "a b"):
        fresh = packing.UnitEncoder(TOKENIZER)
        assert encoder.encode([text]) == fresh.encode([text])


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(2)
    for capacity in (7, 16, 2048):
        lengths = sorted((draw.randint(1, capacity) for _ in range(300)), reverse=True)
        free, wanted = [], []
        for n in lengths:
            fits = [f for f in free if f >= n]
            left = min(fits) if fits else capacity
            wanted.append(capacity - left)
            if fits:
                free.remove(left)
            free.append(left - n)
        placed = packing.best_fit_decreasing(lengths, capacity)
        assert [offset for _, offset in placed] == wanted
        assert len({w for w, _ in placed}) == len(free)


def check(pieces, docs, capacity):
    model = Tokenizer.from_file(TOKENIZER)
    model.encode_special_tokens = True
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            part = np.asarray(ids[at:at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += p.length
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("group", [8192, 16])
def test_all_tokens_lie_in_one_place(documents, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    draw = random.Random(3)
    docs = {i: " ".join(draw.choice(["alpha", "beta", "x"]) for _ in range(draw.randint(0, 150)))
            for i in range(120)} | {500 + i: t for i, t in enumerate(NASTY)} | {900: None}
    pieces = packing.packed_digest(documents(list(docs.items())), TOKENIZER, 64).collect()
    windows = check(pieces, docs, 64)
    tokens = sum(p.length for p in pieces)
    if group == 8192:
        assert tokens / 64 <= windows <= 1.03 * tokens / 64 + 1


def test_ids_come_back(documents):
    rows = packing.pack_documents(documents([(1, "one two three"), (2, None)]), TOKENIZER, 4)
    ids = {(r.doc_id, r.start): np.frombuffer(bytes(r.ids), "<u4").tolist()
           for r in rows.collect()}
    model = Tokenizer.from_file(TOKENIZER)
    assert ids[2, 0] == [1]
    assert ids[1, 0] == [*model.encode("one two three").ids, 1]


def test_odd_rows(odd):
    pieces = packing.packed_digest(odd, TOKENIZER)
    assert pieces.filter("doc_id = 4 AND start = 0").count() == 2
    assert pieces.filter("doc_id IS NULL").count() == 2
    assert pieces.filter("doc_id = 1").first().doc_tokens == 1
    assert packing.packed_digest(odd.limit(0), TOKENIZER).collect() == []
