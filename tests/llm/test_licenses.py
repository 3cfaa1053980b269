from __future__ import annotations

import random
import re

import pytest

from geopanel.llm.licenses import TEMPLATES, license_matches, markers


def bigrams(text):
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return set(zip(words, words[1:], strict=False))


def slow(text):
    units = [("text", 0, text)]
    for kind, parts in (("line", text.split("\n")), ("paragraph", re.split(r"\n[ \t\r]*\n", text))):
        if len(parts) > 1:
            units += [(kind, i, p) for i, p in enumerate(parts, 1)]
    out = set()
    for kind, at, part in units:
        a = bigrams(part)
        for name, template in TEMPLATES.items():
            b = bigrams(template)
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= 0.8:
                out.add((kind, at, name, len(a), len(b), len(a & b), dice))
    return out


TEXTS = [
    TEMPLATES["MIT-text"], "intro words here\n\n" + TEMPLATES["MIT-text"].replace(". ", ".\n")
    + "\n\nmore words follow", "x\nReleased under the MIT License.\ny",
    "Released under a MIT license!", "Licensed under CC-BY NC 4.0", "this work is licensed under",
    "This work is licensed under the GNU General Public License, version 2.", "", "one", "\n\n\n",
    TEMPLATES["GPL-3.0-header"].upper(), "Licensed under the Apache License, Version 2.0.\n" * 3,
]


def test_same_as_brute_force(documents):
    found = license_matches(documents(list(enumerate([*TEXTS, None])))).collect()
    got = {(r.doc_id, r.unit, r.at, r.license, r.n_bigrams, r.n_template, r.n_shared, r.dice)
           for r in found}
    assert got == {(d, *m) for d, text in enumerate(TEXTS) for m in slow(text)}
    assert len(got) == len(found) and len({r.doc_id for r in found}) >= 6


def test_repeated_rows_match_each_for_itself(documents):
    row = (1, "Released under the MIT License.")
    found = license_matches(documents([row, row])).collect()
    assert [(r.doc_id, r.license, r.dice) for r in found] == [(1, "MIT", 1.0)] * 2


def test_odd_rows(odd):
    assert license_matches(odd).collect() == []
    assert license_matches(odd.limit(0)).collect() == []


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95, 1.0])
def test_no_match_without_a_marker(threshold):
    chosen = markers(TEMPLATES, threshold)
    assert len(chosen) == len(set(chosen))
    for template in TEMPLATES.values():
        # As many words of the template as can stand without a marker, in their order.
        words = re.sub("[^a-z0-9]+", " ", template.lower()).split()
        a, b = bigrams(template), bigrams(" ".join(w for w in words if w not in chosen))
        shared = {p for p in a & b}
        best = len({p for p in a if not set(p) & set(chosen)})
        assert 2 * max(best, len(shared)) < threshold * (best + len(a))


def test_texts_at_the_edge_of_a_match(documents):
    draw = random.Random(3)
    texts = []
    for template in TEMPLATES.values():
        for _ in range(12):
            words = template.split()
            for _ in range(draw.randrange(1 + len(words) // 4)):
                words[draw.randrange(len(words))] = draw.choice(["", "other", "LICENSE", "\u212a"])
            texts.append(" ".join(words))
    found = license_matches(documents(list(enumerate(texts)))).collect()
    got = {(r.doc_id, r.unit, r.at, r.license, r.n_bigrams, r.n_template, r.n_shared, r.dice)
           for r in found}
    assert got == {(d, *m) for d, text in enumerate(texts) for m in slow(text)}
