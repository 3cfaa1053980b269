from __future__ import annotations

import re

from hypothesis import given
from hypothesis import strategies as st

from geopanel.llm import quality


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@given(st.lists(st.sampled_from(["a", "b", "é|", "\n", " ", " ", "#", "\x1c", "\t"]),
                max_size=120).map(" ".join))
def test_measures(text):
    assert quality.measures(text.encode()) == slow(text)


def test_equal_keys_of_different_windows(monkeypatch):
    monkeypatch.setattr(quality, "_FACTOR", quality.np.uint64(0))
    text = "a b c d e f g h x c d a f b g h a b c d e f g h q r s t u v w h".split()
    assert quality.repeated_words([w.encode() for w in text]) == slow(" ".join(text))[5] == 16


GOOD = " ".join(f"wort{i}" for i in range(30))


def test_hosts_that_fail_are_held_to_all_rules(documents):
    signs = GOOD + " ####"
    rows = [(i, signs, None, "bad") for i in range(90)]
    rows += [(100 + i, GOOD, None, "bad") for i in range(10)]
    rows += [(200 + i, GOOD, None, f"h{i % 4}") for i in range(100)]
    rows += [(300, signs, None, "h1"), (301, "too short", None, "h1"),
             (302, "same words again and again and on " * 9, None, "h1")]
    found = {r.doc_id: r for r in quality.judge(documents(rows)).collect()}
    assert not any(found[i].kept for i in range(90))
    assert all(found[i].kept for i in [*range(100, 110), *range(200, 300), 300])
    assert found[301].base_failed and not found[301].kept
    assert found[302].base_failed and not found[302].kept
    assert found[0].host_failed and not found[0].base_failed and not found[200].host_failed
    kept = quality.keep_good(documents(rows))
    assert kept.count() == 10 + 100 + 1 and "text" in kept.columns


def test_rates_shrink_to_the_prior(documents):
    rows = [(i, GOOD if i % 10 else "x", None, f"h{i % 7}") for i in range(700)]
    rows += [(1000, "x", None, "tiny")]
    found = {r.host: r for r in quality.judge(documents(rows)).select(
        "host", "host_rate", "host_failed").distinct().collect()}
    # One failure of one document says little about its host.
    assert found["tiny"].host_rate < 1
    assert found["h0"].host_rate < 0.3


def verdicts(documents, rows):
    return {r.host: r for r in quality.judge(documents(rows)).select(
        "host", "host_rate", "host_failed").distinct().collect()}


def test_one_document_does_not_condemn_its_host(documents):
    signs = GOOD + " ####"
    # Hosts of one document tell nothing about hosts: all are near the mean.
    alone = verdicts(documents, [
        (i, signs if i % 10 < 3 else GOOD, None, f"h{i}") for i in range(200)])
    assert not any(r.host_failed or abs(r.host_rate - 0.3) > 0.01 for r in alone.values())
    # Hosts that are all good or all bad, and small ones beside them.
    rows = [(i, signs if i < 120 else GOOD, None, f"big{i // 40}") for i in range(400)]
    rows += [(1000 + i, signs, None, f"small{i}") for i in range(5)]
    rows += [(2000 + i, signs, None, "twenty") for i in range(20)]
    found = verdicts(documents, rows)
    assert {h for h, r in found.items() if r.host_failed} == {"big0", "big1", "big2", "twenty"}
    assert found["small0"].host_rate > found["big5"].host_rate


def test_prior_finds_the_strength_that_hosts_were_drawn_with():
    draw = quality.np.random.default_rng(5)
    n = draw.integers(1, 30, 20_000).astype(float)
    bad = draw.binomial(n.astype(int), draw.beta(0.2 * 8, 0.8 * 8, n.size)).astype(float)
    mean, strength = quality._prior(
        n.size, n.sum(), (n * n).sum(), bad.sum(), (bad * bad / n).sum(), 0.5)
    assert abs(mean - 0.2) < 0.01 and 7 < strength < 9
    even = draw.binomial(n.astype(int), 0.2).astype(float)
    assert quality._prior(n.size, n.sum(), (n * n).sum(), even.sum(),
                          (even * even / n).sum(), 0.5)[1] > 100


def test_odd_rows(odd):
    found = quality.judge(odd).collect()
    assert len(found) == odd.count()
    assert all(r.base_failed and not r.kept for r in found if r.doc_id in (1, 2, 3, 8, 10))
    assert quality.judge(odd.limit(0)).collect() == []
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
