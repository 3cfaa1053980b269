from __future__ import annotations

import random

from hypothesis import given
from hypothesis import strategies as st

from geopanel.llm import linededup


def line(i, n=8):
    return " ".join(f"l{i}w{k}" for k in range(n))


@given(st.lists(st.integers(0, 12), max_size=30), st.lists(st.integers(0, 12), max_size=30))
def test_alignment_is_an_alignment(a, b):
    pairs = linededup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))


@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 5)), max_size=10))
def test_heaviest_rising(rows):
    pairs, weights = [(i, v) for i, (v, _) in enumerate(rows)], [w for _, w in rows]
    best = list(weights)
    for i in range(len(rows)):
        best[i] += max((best[j] for j in range(i) if rows[j][0] < rows[i][0]), default=0)
    chain = linededup.longest_rising(pairs, weights)
    assert sum(weights[i] for i, _ in chain) == max(best, default=0)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(chain, chain[1:], strict=False))


@given(st.permutations(range(9)))
def test_longest_rising(order):
    pairs = list(enumerate(order))
    best = [1] * len(order)
    for i in range(len(order)):
        for j in range(i):
            if order[j] < order[i]:
                best[i] = max(best[i], best[j] + 1)
    chain = linededup.longest_rising(pairs)
    assert len(chain) == max(best)
    assert all(x[1] < y[1] for x, y in zip(chain, chain[1:], strict=False))


def test_unique_lines_are_the_anchors():
    a = [1, 9, 2, 9, 3]
    assert linededup.patience(a, [7, 1, 2, 9, 3, 8]) == [(0, 1), (2, 2), (3, 3), (4, 4)]
    assert linededup.patience([], [1]) == []


def slow(docs, min_words, over_blank=False):
    """Every later document against all earlier ones: any run of lines with words in common."""
    rows = {d: [(i, x.strip(" "), len(x.split())) for i, x in enumerate(t.split("\n"))
                if x.split()] for d, t in docs.items() if t is not None}
    places = {}
    for d in sorted(rows):
        for i, (_, x, _) in enumerate(rows[d]):
            places.setdefault(x, []).append((d, i))
    out = {}
    for d, own in rows.items():
        gone = set()
        for i in range(len(own)):
            for e, j in places[own[i][1]]:
                other, n = rows[e], 1
                while (e < d and i + n < len(own) and j + n < len(other)
                       and own[i + n][1] == other[j + n][1]
                       and (over_blank or own[i + n][0] - own[i][0] == other[j + n][0] - other[j][0]
                            == n)):
                    n += 1
                if e < d and sum(r[2] for r in own[i:i + n]) >= min_words:
                    gone |= set(range(own[i][0], own[i + n - 1][0] + 1))
        out[d] = "\n".join(x for i, x in enumerate(docs[d].split("\n")) if i not in gone)
    return out


def test_same_as_brute_force(documents):
    draw = random.Random(4)
    passage = [line(f"p{i}") for i in range(6)]
    docs = {}
    for d in range(80):
        own = [line(f"{d}x{i}", draw.randint(1, 9)) for i in range(draw.randint(0, 12))]
        if d % 3 == 0:
            at = draw.randint(0, len(own))
            own[at:at] = passage[draw.randint(0, 2):]
        if d % 5 == 0 and d:
            own += docs[draw.randrange(d)].split("\n")[:draw.randint(1, 8)]
        if d % 7 == 0:
            own = ["menu home about", *own, "", "all rights reserved"]
        docs[d] = "\n".join(own)
    docs[200] = docs[3]
    docs[201] = None
    found = linededup.drop_repeated_lines(documents(list(docs.items())), 20).collect()
    got = {r.doc_id: r.text for r in found}
    assert got.pop(201) is None
    assert got == slow(docs, 20)
    assert got[200] == "" and sum(r.n_removed for r in found) > 40
    # The first holder keeps every line, and boilerplate of a few words stays everywhere.
    kept = {x for t in got.values() for x in t.split("\n")}
    assert kept >= {x for t in docs.values() if t for x in t.split("\n")}
    assert all("menu home about" in got[d] for d in range(0, 80, 7) if got[d])


def test_long_passages_go_from_all_but_the_first(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{line(i)}\n{passage}\n{line(-i)}") for i in range(1, 300)]
    got = {r.doc_id: r for r in linededup.drop_repeated_lines(documents(rows)).collect()}
    assert passage in got[1].text
    assert all(passage not in got[i].text and got[i].n_removed == 1 for i in range(2, 300))


def test_odd_rows(odd):
    found = linededup.drop_repeated_lines(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_removed"]
    rows = found.collect()
    assert len(rows) == odd.count()
    assert all(r.n_removed == 0 for r in rows)
    assert linededup.drop_repeated_lines(odd.limit(0)).collect() == []


def any_common_run(docs, min_words):
    """Every later document against all earlier ones: any run of lines with words in common."""
    rows = {d: [(i, x.strip(" "), len(x.split())) for i, x in enumerate(t.split("\n"))
                if x.split()] for d, t in docs.items()}
    out = {}
    for d, own in rows.items():
        gone = set()
        for other in (rows[e] for e in rows if e < d):
            for i in range(len(own)):
                for j in range(len(other)):
                    n = 0
                    while (i + n < len(own) and j + n < len(other)
                           and own[i + n][1] == other[j + n][1]):
                        n += 1
                    if n and sum(r[2] for r in own[i:i + n]) >= min_words:
                        gone |= set(range(own[i][0], own[i + n - 1][0] + 1))
        out[d] = "\n".join(x for i, x in enumerate(docs[d].split("\n")) if i not in gone)
    return out


def short(documents, docs, min_words=30):
    found = linededup.drop_repeated_lines(
        documents(list(docs.items())), min_words, over_blank=True).collect()
    return {r.doc_id: r.text for r in found}


WORDS = [1, 1, 2, 3, 5, 8]


@given(*[st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=24) for _ in range(2)],
       st.integers(1, 14))
def test_repeated_alignment_leaves_no_common_run(a, b, min_words):
    kept = [(i, x) for i, x in enumerate(a) if x is not None]
    later = [(i, x, WORDS[x]) for i, x in enumerate(b) if x is not None]
    wanted = set()
    for i, x, _ in later:
        for j in (j for j, y in kept if x == y):
            n = 0
            while (i + n < len(b) and j + n < len(a) and b[i + n] is not None
                   and b[i + n] == a[j + n]):
                n += 1
            if sum(WORDS[y] for y in b[i:i + n]) >= min_words:
                wanted |= set(range(i, i + n))
    assert linededup.common_blocks(kept, later, min_words) == sorted(wanted)


def test_everything_is_deleted_by_alignment(monkeypatch):
    later = [(i, i, 8) for i in range(12)]
    kept = [(i, (i + 6) % 12) for i in range(12)]
    assert linededup.common_blocks(kept, later, 30) == list(range(12))
    monkeypatch.setattr(linededup, "patience", lambda *_: [])
    assert linededup.common_blocks(kept, later, 30) == []


def test_rows_of_one_id_with_different_texts(documents):
    block = "\n".join(line(i) for i in range(9))
    rows = [(1, block), (2, f"{line(80)}\n{block}"), (2, line(81)), (2, block)]
    found = linededup.drop_repeated_lines(documents(rows)).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 2, 2] and found


def test_paragraphs_parted_by_blank_lines(documents):
    a, b = line("a", 28), line("b", 28)
    got = short(documents, {1: f"x\n{a}\n\n{b}\ny", 2: f"v\n{a}\n\n{b}\nw", 3: f"{a}\n \n\n{b}"})
    assert got == {1: f"x\n{a}\n\n{b}\ny", 2: "v\nw", 3: ""}


def test_block_of_lines_first_seen_in_other_documents(documents):
    rows = [line(i, 20) for i in range(3)]
    block = "\n".join(rows)
    docs = {i + 1: f"{line(f'o{i}')}\n{rows[i]}" for i in range(3)}
    docs |= {4: f"four\n{block}", 5: f"five\n{block}", 6: f"four\n{block}"}
    assert short(documents, docs) == docs | {5: "five", 6: ""}


def test_passages_that_cross_go_too(documents):
    p, q, menu = line("p", 60), line("q", 40), "home\nabout\ncontact"
    docs = {1: f"{p}\n{menu}", 2: f"{menu}\n{p}", 3: f"{q}\n{p}", 4: f"{p}\n{q}",
            5: f"e\n{q}\nf\n{p}\ng\n{q}\nh"}
    assert short(documents, docs) == {1: docs[1], 2: menu, 3: q, 4: "", 5: "e\nf\ng\nh"}


def test_no_common_run_is_left(documents):
    draw = random.Random(9)
    docs = {d: "\n".join(draw.choice([line(draw.randint(0, 5), draw.choice([3, 9])), "", "x y"])
                         for _ in range(draw.randint(0, 14))) for d in range(60)}
    wanted = any_common_run(docs, 12)
    assert short(documents, docs, 12) == wanted
    assert sum(wanted[d] != docs[d] for d in docs) > 10
