from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np

from geopanel.llm import secrets
from geopanel.llm.crf import ChainCRF


def slow(text):
    found = []
    for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|"
                         r"[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
                         r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text)
              if len(m.group()) >= 16]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


PARTS = ["password", "PassWd", "toKen", "api_key", "APIKEY", "secret", "ſecret", "toKen", '"', "'",
         " ", "  ", ":", "=", "=", "abcdefghijkl", "0123456789abcdef", "AKIA", "AKIA" + "Z9" * 8,
         "\n", "é", "\U0001f600", "short", "x" * 30, "-", "."]


def test_base_spans():
    draw = random.Random(8)
    for _ in range(4000):
        text = "".join(draw.choices(PARTS, k=draw.randint(0, 12)))
        assert secrets.base_spans(text) == slow(text), repr(text)


def test_best_labels_are_the_most_likely():
    draw = np.random.default_rng(2)
    model = ChainCRF(3, 20)
    model.emit[:], model.move[:], model.start[:] = (
        draw.normal(size=x.shape) for x in (model.emit, model.move, model.start))
    for n in range(1, 6):
        chain = [draw.integers(1, 20, 3).tolist() for _ in range(n)]

        def score(tags, chain=chain):
            out = model.start[tags[0]] + sum(model.move[a, b] for a, b in zip(
                tags, tags[1:], strict=False))
            return out + sum(model.emit[t, y].sum() for t, y in zip(chain, tags, strict=True))

        best = max(itertools.product(range(3), repeat=n), key=score)
        assert tuple(model.decode(chain)) == best


def test_fit_separates_by_context():
    # Feature 3 is a secret only beside feature 1, or behind a secret; padding must not matter.
    chains = [[[5], [3, 1]], [[4], [3]], [[4], [4], [5], [3, 1], [3]], [[3]], [[5], [4]]] * 4
    labels = [[0, 1], [0, 0], [0, 0, 0, 1, 2], [0], [0, 0]] * 4
    model = ChainCRF(3, 6).fit(chains, labels, rounds=300)
    assert [model.decode(c) for c in chains] == labels


def corpus(draw):
    words = ["lorem", "ipsum", "token", "value", "report", "mail", "server"]
    def secret(alphabet, n):
        return "".join(draw.choice(alphabet) for _ in range(n))
    out = []
    for i in range(300):
        body = [draw.choice(words) for _ in range(40)]
        if i % 3 == 0:
            body.insert(20, draw.choice([
                f"password={secret('0123456789abcdef', 18)}", f"AKIA{secret('ABCDEFGH234567', 16)}",
                f'token = "{secret("0123456789abcdef", 40)}"']))
        if i % 3 == 1:
            body.insert(10, draw.choice([
                f"someone.{draw.randint(10, 99)}@mail{i % 9}.example.com", f"54.158.{i}.199",
                f"report-2024-01-{i:02d}.final.pdf", "version-1.2.3-release"]))
        out.append(" ".join(body))
    return out


def test_the_field_adds_what_patterns_miss():
    draw = random.Random(3)
    model = secrets.train(corpus(draw))
    text = 'lorem ipsum token = "' + "9F" * 4 + "A0C3D4E5F60718293A4B5C6D7E8F9" + '" report'
    fresh = "value AKIB" + "Q7XW2ZJ4K5H6G3F2" + " mail sk_" + "a8Kd93LmZx02QpWn47TyVbRc" + " report"
    assert secrets.base_spans(fresh) == []
    added = secrets.crf_spans(fresh, model, [])
    assert any(fresh[a:b].endswith("a8Kd93LmZx02QpWn47TyVbRc") for _, a, b in added)
    assert all(re.search("[A-Za-z0-9]{8}", fresh[a:b]) for _, a, b in added)
    assert secrets.crf_spans(text, model, secrets.base_spans(text)) == []
    web = "see https://www.example.com/path/page1234/index.html and /usr/lib/file12.so.7"
    assert secrets.crf_spans(web, model, []) == []
    clean = "write to tne.95@mail6.example.com or 54.158.173.199 on report-2024-01-02.final.pdf"
    assert secrets.crf_spans(clean, model, []) == []


def test_labels_are_those_of_the_plain_chain(monkeypatch):
    draw = random.Random(6)
    texts = corpus(draw)
    model = secrets.train(texts[:120])
    tried = [secrets.planted(t, draw)[0] for t in texts[120:170]]
    tried += ["", " ", "x", "pass=Zq9!x", "é" * 40 + " token 漢字\u0301 Ab1!Cd2@Ef3#", "\n\x1c key\xa0A9!b"]
    for step in (1 << 18, 3):
        monkeypatch.setattr(secrets, "STEP", step)
        monkeypatch.setattr(secrets, "REMEMBERED", 50 if step == 3 else 100_000)
        for text in tried:
            places, chain = secrets.chain_of(text)
            assert [text[a:b] for a, b in places] == re.findall(r"[^\W_]+|\S", text)
            tokens, runs = model.labels(text)
            got = [0] * len(places)
            for first, tags in runs:
                got[first:first + len(tags)] = tags
            numbers = [[model.names.get(f, 0) for f in token] for token in chain]
            assert got == (model.field.decode(numbers) if chain else [])
            assert not places or list(zip(tokens.begins, tokens.ends, strict=True)) == places


def test_texts_tagged_together_are_tagged_alike(monkeypatch):
    draw = random.Random(8)
    texts = corpus(draw)
    model = secrets.train(texts[:120])
    tried = [secrets.planted(t, draw)[0] for t in texts[120:200]]
    tried[7:7] = ["", " \n", "pass=Zq9!x", "Zq9!xAb1Cd2Ef3Gh4", "", "key"]
    base = [secrets.base_spans(t) for t in tried]
    alone = [secrets.crf_spans(t, model, b) for t, b in zip(tried, base, strict=True)]
    assert sum(map(bool, alone)) > 40
    for step in (1 << 18, 500, 3):
        monkeypatch.setattr(secrets, "STEP", step)
        assert list(secrets.crf_spans_of(tried, model, base)) == alone
    assert list(secrets.crf_spans_of([], model, [])) == []


def test_runs_between_certain_tokens_have_the_best_labels():
    draw = np.random.default_rng(4)
    model = ChainCRF(3, 2)
    for _ in range(300):
        model.move[:], model.start[:] = draw.normal(size=(3, 3)), draw.normal(size=3)
        score = draw.normal(size=(9, 3)) + np.where(draw.random((9, 1)) < 0.5, [4, 0, 0], 0)
        whole = model.best(score)
        sure = (score[:, [0]] - score > model.lead(0))[:, 1:].all(1)
        assert not np.array(whole)[sure].any()
        for run in np.split(np.flatnonzero(~sure), np.flatnonzero(np.diff(np.flatnonzero(~sure)) != 1) + 1):
            if run.size:
                assert model.best(score[run], 0 if run[0] else None,
                                  0 if run[-1] < 8 else None) == whole[run[0]:run[-1] + 1]


def test_held_out_secrets_and_clean_texts():
    draw = random.Random(21)
    texts = corpus(draw)
    model = secrets.train(texts[:200])
    found = clean = 0
    for text in texts[200:]:
        if not secrets.base_spans(text):
            clean += bool(secrets.crf_spans(text, model, []))
            with_one, ((_, a, b),) = secrets.planted(text, draw)
            found += any(x <= a and b <= y or a <= x and y <= b and 2 * (y - x) >= b - a
                         for _, x, y in secrets.crf_spans(with_one, model, []))
    assert clean <= 2 and found >= 45
    # Short, of letters only, with signs, and beside a match of a pattern.
    for text, secret in [
            ("we said db_pass is hunter2!@#$Xy and left", "hunter2!@#$Xy"),
            ("the API key ... AbCdEfGhIjKlMnOpQrStUvWx was", "AbCdEfGhIjKlMnOpQrStUvWx"),
            ("key ghp_abcdefghijklmnopqrstuvwxyzABCDEFGHIJ here", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"),
            ("pwd=Kz7mQ2xw9 now", "Kz7mQ2xw9")]:
        assert any(secret in text[a:b] for _, a, b in secrets.crf_spans(text, model, [])), text
    text = "token 0123456789abcdef0Zk3TqLmN8VxW report"
    base = secrets.base_spans(text)
    assert base == [("hex", 6, 23)]
    assert any(a <= 6 and b > 23 for _, a, b in secrets.crf_spans(text, model, base))


def test_query_columns(documents):
    draw = random.Random(3)
    rows = list(enumerate([*corpus(draw), None, "", "x" * 100_000 + " password: abcdefghijklmnop"]))
    found = {r.doc_id: r for r in secrets.find_secrets(documents(rows)).collect()}
    assert len(found) == len(rows)
    for d, text in rows:
        base = slow(text or "")
        r = found[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [
            sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s and not s.startswith("crf")]
        assert ",".join(spans) == joined


def test_odd_rows(odd):
    found = secrets.find_secrets(odd).collect()
    assert len(found) == odd.count() and all(r.n_crf == 0 for r in found)
    assert secrets.find_secrets(odd.limit(0)).collect() == []
