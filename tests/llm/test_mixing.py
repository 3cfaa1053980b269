from __future__ import annotations

from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from geopanel.llm import mixing
from geopanel.llm.queries import MIX_LEVELS, MIX_WEIGHTS

LEVELS = {"lang": "lang", "source": "source"}
WEIGHTS = {"lang": "IF(lang = 'en', 3, 1)", "source": "IF(source = 'none', 0, 2)"}


def fill(budget, children):
    """Shares of (name, weight, capacity) with shortages spread over the others, by rounds."""
    out = {}
    left = [c for c in children if c[1] > 0]
    while left:
        total = sum(w for _, w, _ in left)
        full = [c for c in left if Fraction(budget * c[1], total) >= c[2]]
        if not full:
            return out | {n: budget * w // total for n, w, _ in left}
        for name, _, cap in full:
            out[name] = cap
            budget -= cap
        left = [c for c in left if c not in full]
    return out


def slow(rows, share, epochs, seed):
    """(doc_id, epoch) of what is taken, with the tree of LEVELS and WEIGHTS."""
    docs = [(d, (t or "").split(), lang or "", src or "") for d, t, lang, src in rows]
    docs = [(d, len(w), lang, src) for d, w, lang, src in docs if w]
    tokens = {}
    for _, n, lang, src in docs:
        tokens[lang, src] = tokens.get((lang, src), 0) + n

    def weight(src):
        return 0 if src == "none" else 2

    caps = {leaf: n * epochs if weight(leaf[1]) else 0 for leaf, n in tokens.items()}
    langs = sorted({lang for lang, _ in tokens})
    top = [(lang, 3 if lang == "en" else 1, sum(c for (g, _), c in caps.items() if g == lang))
           for lang in langs]
    budget = min(int(sum(tokens.values()) * share), sum(c for _, _, c in top))
    alloc = {}
    for lang, b in fill(budget, top).items():
        kids = [(leaf, weight(leaf[1]), caps[leaf]) for leaf in caps if leaf[0] == lang]
        alloc |= fill(b, kids)
    out = []
    for leaf, n in tokens.items():
        whole, rest = divmod(alloc.get(leaf, 0), n)
        mine = [(d, k) for d, k, lang, src in docs if (lang, src) == leaf]
        out += [(d, e) for d, _ in mine for e in range(whole)]
        used = 0
        for d, k in sorted(mine, key=lambda x: md5(f"{seed}:{whole}:{x[0]}".encode()).hexdigest()):
            used += k
            if used > rest:
                break
            out.append((d, whole))
    return sorted(out)


ROWS = [(i, "w " * (1 + i * 7 % 23), "en" if i % 3 else "de", f"s{i % 4}") for i in range(200)] + [
    (300 + i, "w " * 9, "fr", "tiny") for i in range(3)] + [
    (400 + i, "w " * 5, "en", "none") for i in range(5)] + [
    (500, "", "en", "s1"), (501, None, None, None), (502, "one two", None, None)]


@pytest.mark.parametrize("share, epochs", [(0.5, 1), (1.0, 3), (2.5, 2), (10.0, 2), (0.0, 1)])
@pytest.mark.parametrize("steps", [3, 1])
def test_same_as_brute_force(documents, monkeypatch, share, epochs, steps):
    monkeypatch.setattr(mixing, "DIGITS", 1)
    monkeypatch.setattr(mixing, "STEPS", steps)
    got = mixing.mix(documents(ROWS), LEVELS, WEIGHTS, budget_share=share, max_epochs=epochs,
                     seed=7)
    assert sorted((r.doc_id, r.epoch) for r in got.collect()) == slow(ROWS, share, epochs, 7)


def test_shortage_goes_to_siblings_first(documents):
    rows = [(i, "w " * 10, "en", "small" if i < 2 else "large") for i in range(40)]
    rows += [(100 + i, "w " * 10, "de", "other") for i in range(100)]
    got = mixing.mix(documents(rows), LEVELS, {}, budget_share=0.4, max_epochs=1)
    sums = {r["source"]: r["n"] for r in got.groupBy("source").agg(
        F.sum("n_tokens").alias("n")).collect()}
    # Half of 560 to each language; what the small source lacks stays in its language.
    assert sums == {"small": 20, "large": 260, "other": 280}


def test_chosen_documents_keep_their_columns(documents):
    docs = documents(ROWS)
    got = mixing.mix_documents(docs, LEVELS, WEIGHTS, budget_share=1.0, max_epochs=3, seed=7)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [d for d, _ in slow(ROWS, 1.0, 3, 7)]


def test_odd_rows(odd):
    got = mixing.mix(odd, MIX_LEVELS, MIX_WEIGHTS, budget_share=3.0, max_epochs=3)
    found = got.collect()
    assert {r.doc_id for r in found} == {None, 4, 7, 8, 9, 10}
    assert mixing.mix(odd.limit(0), MIX_LEVELS, MIX_WEIGHTS).collect() == []
    rows = mixing.mix_documents(odd, MIX_LEVELS, MIX_WEIGHTS)
    assert rows.columns == odd.columns and rows.count() > 0
