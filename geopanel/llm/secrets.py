"""Secrets in texts: fixed patterns, and a conditional random field for what they miss."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import pick, sample_rows
from geopanel.llm.crf import ChainCRF

ASSIGN = re.compile(
    r"(?a:(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+))")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: What a text must hold for ASSIGN to match, looked up in its bytes with A-Z lower-cased.
HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
#: Bytes that HEX matches as 0, all others as blanks.
_HEXED = bytes(48 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = range(3)
#: A token with the blanks before it; a token without any is glued to the one before.
TOKEN = re.compile(r"\s*(?:[^\W_]+|\S)")
BLANK = re.compile(r"\s")
#: Where tokens can be cut apart: each side has the tokens that it has in the whole text.
CUT = re.compile(r"(?<=\S)\s")
#: Characters that are cut into tokens at a time, and tokens that are scored at a time.
STEP = 1 << 18
#: Different tokens whose scores are remembered.
REMEMBERED = 250_000
#: Training: characters on either side of a place, tokens of a chain, least count of a feature.
REACH = 100
LONGEST = 48
LEAST = 5

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns that are long enough, by start, then kind."""
    found: list[Span] = []
    data = text.encode("utf-8", "surrogatepass")
    # Of bytes only A-Z are lower-cased: other letters could hide or fake a hint.
    low = data.lower()
    if any(h in low for h in HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 18]
    if b"0" * 16 in data.translate(_HEXED):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def file_features(text: str) -> list[str]:
    """Coarse marks of the whole text: size, lines, share of code and table signs."""
    n = max(1, len(text))
    signs = sum(text.count(c) for c in "{};=")
    return [f"size{int(math.log10(n))}", f"code{min(3, int(200 * signs / n))}",
            f"lines{min(3, text.count(chr(10)) // 20)}"]


class _Classes(dict):
    """Small letters, capitals, digits and others by code point, for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = ("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit()
                      else "x" if c.isalnum() else ".")
        return self[code]


_CLASSES = _Classes()
#: Classes of characters in the bits of a mask; letters without case and signs share one.
_BITS = {"a": 1, "A": 2, "0": 4, "x": 8, ".": 8}


@lru_cache(1 << 14)
def _of_classes(classes: str) -> tuple[int, int, int, int, int]:
    """Mask, length, changes between letters and digits and of case, share of digits."""
    n = len(classes)
    turns = sum(classes.count(x) for x in ("a0", "0a", "A0", "0A"))
    return (sum({_BITS[c] for c in set(classes)}), min(10, n // 4), min(6, turns),
            min(6, classes.count("aA")), int(5 * classes.count("0") / n) if n else 0)


def shape_of(token: str) -> tuple:
    """Mask and size, then changes, share of digits, variety, share of vowels, hex digits only."""
    if len(token) == 1 and not token.isalnum():
        return _of_classes(token.translate(_CLASSES))[0], 0, token
    mask, size, turns, cases, digits = _of_classes(token.translate(_CLASSES))
    low = token.lower()
    return (mask, size, turns, cases, digits, min(20, len(set(token))),
            5 * sum(map(low.count, "aeiou")) // max(1, len(token)),
            not low.strip("0123456789abcdef"))


def own_features(shape: tuple, glued: bool) -> list[str]:
    """Of a token by itself; most go with whether it is glued to the one before."""
    mask, size, *more = shape
    if len(more) == 1:
        return ["b", f"glued{glued}", f"sign{more[0]}g{glued}"]
    turns, cases, digits, variety, vowels, hexed = more
    return ["b", f"glued{glued}", *(f"{f}g{glued}" for f in (
        f"len{size}", f"kind{mask}", f"kind{mask}len{size}", f"variety{variety}len{size}",
        f"turns{turns}", f"cases{cases}", f"digits{digits}", f"vowels{vowels}kind{mask}",
        f"hex{hexed}kind{mask}"))]


#: Where a token can stand beside another: next to it, or beside the piece that it is in.
PLACES = ("before", "after", "left1", "left2", "left3", "right")


def word_of(token: str) -> str:
    """What a token is known by to its neighbours: a plain word or a sign; else nothing."""
    return token.lower() if len(token) <= 20 and not token[:1].isdigit() else ""


def near_features(place: str, shape: tuple, word: str) -> list[str]:
    """Kind and length of a token, and the word itself; no shape stands for the edge of a text."""
    if not shape:
        return [f"{place}:edge"]
    kind = f"{place}:{shape[0]},{min(3, shape[1])}"
    return [kind, f"{place}:word:{word}"] if word else [kind]


SIZES, MASKS, COUNTS = 13, 16, 10


def piece_features(form: int) -> list[str]:
    """Of the piece between blanks that a token is in: length, classes, number of tokens."""
    rest, count = divmod(form, COUNTS)
    size, mask = divmod(rest, MASKS)
    return [f"piece{size}:{mask}", f"pieces{count}:{mask}"]


#: Kinds that stand behind every text: as many edges as a feature looks back.
EDGES = np.zeros(3, np.int64)


class Tokens:
    """The tokens of texts as arrays: what they are, where they are, which piece they are in.

    Behind the tokens of each text stand ``EDGES``, of kind 0, each a piece of its own.
    """

    def __init__(self, kinds: np.ndarray, first: np.ndarray, held: np.ndarray):
        self.kinds = kinds
        glued, length, mask, taken = held[kinds, :4].T
        #: The text of each token; ``first`` has the first token of each text.
        self.of = np.repeat(np.arange(first.size), np.diff(np.append(first, kinds.size)))
        ends = np.cumsum(taken)
        #: Where every token ends and begins in its text, edges included.
        self.to = ends - (ends - taken)[first][self.of] if first.size else ends
        self.at = self.to - length
        apart = glued == 0
        apart[first] = True
        self.first = np.flatnonzero(apart)
        self.piece = np.cumsum(apart) - 1
        size = np.add.reduceat(length, self.first) if kinds.size else length
        count = np.diff(np.append(self.first, kinds.size))
        self.form = ((np.minimum(SIZES - 1, size // 4) * MASKS + (
            np.bitwise_or.reduceat(mask, self.first) if kinds.size else mask)) * COUNTS
            + np.minimum(COUNTS - 1, count))

    @property
    def begins(self) -> np.ndarray:
        return self.at[self.kinds != 0]

    @property
    def ends(self) -> np.ndarray:
        return self.to[self.kinds != 0]

    def beside(self) -> dict[str, np.ndarray]:
        """The kinds that stand left and right of each piece; 0 is the edge of a text."""
        padded = np.concatenate([EDGES, self.kinds, EDGES])
        after = np.append(self.first[1:], self.kinds.size)
        return {"left1": padded[self.first + 2], "left2": padded[self.first + 1],
                "left3": padded[self.first], "right": padded[after + 3]}


class _Numbers(dict):
    """Numbers of tokens, given out as they are met."""

    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, key: str) -> int:
        self[key] = number = self.add(key)
        return number


class Reader:
    """Cuts texts into tokens and numbers the different ones; 0 is the edge of a text."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers(self.add)
        self.cores: list[str] = [""]
        #: Glued, length, mask and length with blanks; more in a subclass.
        self.held = np.zeros((1, 6), np.int64)
        self.new: list[tuple[int, ...]] = []

    def add(self, key: str) -> int:
        core = key.lstrip()
        self.cores.append(core)
        self.new.append(self.describe(core, len(core) == len(key), len(key)))
        return len(self.cores) - 1

    def describe(self, core: str, glued: bool, taken: int) -> tuple[int, ...]:
        return glued, len(core), _of_classes(core.translate(_CLASSES))[0], taken, 0, 0

    def tokens(self, texts: list[str]) -> Tokens:
        if len(self.known) > REMEMBERED:
            self.clear()
        number, kinds, first, size = self.known.__getitem__, [], [], 0
        for text in texts:
            at = 0
            first.append(size)
            while at < len(text):
                found = CUT.search(text, at + STEP)
                upto = found.start() if found else len(text)
                cut = TOKEN.findall(text, at, upto)
                kinds.append(np.fromiter(map(number, cut), np.int64, len(cut)))
                size += len(cut)
                at = upto
            kinds.append(EDGES)
            size += EDGES.size
        if self.new:
            begin = len(self.cores) - len(self.new)
            if len(self.cores) > len(self.held):
                room = np.zeros((2 * len(self.cores), 6), np.int64)
                room[:begin] = self.held[:begin]
                self.held = room
            self.held[begin:len(self.cores)] = self.new
            self.new = []
        return Tokens(np.concatenate(kinds) if kinds else EDGES[:0],
                      np.array(first, np.int64), self.held)


def chain_of(text: str) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """(spans of the tokens, names of their features) of a whole text."""
    reader = Reader()
    tokens = reader.tokens([text])
    marks = file_features(text)
    of = [((), "")] + [(shape_of(c), word_of(c)) for c in reader.cores[1:]]
    kinds, n = tokens.kinds.tolist(), tokens.kinds.size - EDGES.size
    padded = [0, *kinds]
    beside = {place: near.tolist() for place, near in tokens.beside().items()}
    out = []
    for i, (kind, p) in enumerate(zip(kinds[:n], tokens.piece[:n].tolist(), strict=True)):
        out.append([
            *own_features(of[kind][0], bool(reader.held[kind, 0])),
            *near_features("before", *of[padded[i]]), *near_features("after", *of[padded[i + 2]]),
            *(f for place in PLACES[2:] for f in near_features(place, *of[beside[place][p]])),
            *piece_features(int(tokens.form[p])), *marks])
    return list(zip(tokens.begins.tolist(), tokens.ends.tolist(), strict=True)), out


class Tagger(Reader):
    """A fitted field that reads texts: ``names`` numbers its features, others weigh nothing.

    Weights are added up once per shape, word and form of a piece; a text looks them up.
    """

    def __init__(self, field: ChainCRF, names: dict[str, int]):
        self.field, self.names = field, names
        self.words = {f.split(":", 2)[2] for f in names if ":word:" in f}
        self.forms = np.array([self.weight(piece_features(form))
                               for form in range(SIZES * MASKS * COUNTS)])
        self.own_rows, self.own_of = [np.zeros(3)], {}
        self.near_rows, self.near_of = [self._near((), "")], {}
        super().__init__()

    def __reduce__(self):
        return Tagger, (self.field, self.names)

    def weight(self, features: list[str]) -> np.ndarray:
        return self.field.emit[[self.names.get(f, 0) for f in features]].sum(0)

    def clear(self) -> None:
        super().clear()
        # Neighbours differ by kinds and learnt words alone; shapes are more, but few.
        if len(self.own_of) > REMEMBERED:
            self.own_rows, self.own_of = [np.zeros(3)], {}

    def _near(self, shape: tuple, word: str) -> np.ndarray:
        return np.array([self.weight(near_features(p, shape, word)) for p in PLACES])

    def describe(self, core: str, glued: bool, taken: int) -> tuple[int, ...]:
        shape, word = shape_of(core), word_of(core)
        own = (shape, glued)
        near = (shape[0], min(3, shape[1]), word if word in self.words else "")
        if own not in self.own_of:
            self.own_of[own] = len(self.own_rows)
            self.own_rows.append(self.weight(own_features(shape, glued)))
        if near not in self.near_of:
            self.near_of[near] = len(self.near_rows)
            self.near_rows.append(self._near(shape, word))
        return glued, len(core), shape[0], taken, self.own_of[own], self.near_of[near]

    def scores(self, texts: list[str]) -> Iterator[tuple[Tokens, int, np.ndarray]]:
        """(tokens, first of them, scores of the next ``STEP``) of texts."""
        tokens = self.tokens(texts)
        own, near = self.tables()
        of_own, of_near = self.held[:, 4], self.held[:, 5]
        marks = np.array([self.weight(file_features(text)) for text in texts]).reshape(-1, 3)
        piece = self.forms[tokens.form] + marks[tokens.of[tokens.first]]
        for place, kinds in tokens.beside().items():
            piece += near[of_near[kinds], PLACES.index(place)]
        padded = of_near[np.concatenate([EDGES[:1], tokens.kinds, EDGES[:1]])]
        for a in range(0, tokens.kinds.size, STEP):
            b = min(a + STEP, tokens.kinds.size)
            yield tokens, a, (own[of_own[tokens.kinds[a:b]]] + near[padded[a:b], 0]
                              + near[padded[a + 2:b + 2], 1] + piece[tokens.piece[a:b]])

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """All rows so far as arrays, which grow at the end only."""
        out = []
        for name, rows in (("own", self.own_rows), ("near", self.near_rows)):
            held = self.__dict__.get(f"{name}_table")
            if held is None or held[0] is not rows:
                held = (rows, np.array(rows), len(rows))
            elif held[2] < len(rows):
                table = held[1]
                if len(table) < len(rows):
                    table = np.concatenate([table, np.zeros((len(rows), *table.shape[1:]))])
                table[held[2]:len(rows)] = rows[held[2]:]
                held = (rows, table, len(rows))
            self.__dict__[f"{name}_table"] = held
            out.append(held[1])
        return out[0], out[1]

    def labels(self, *texts: str) -> tuple[Tokens | None, list[tuple[int, list[int]]]]:
        """Tokens, and (first token, labels) of runs; all tokens between runs are outside.

        A token whose score for outside leads by more than all transitions can make up for is
        outside in the best labelling, so the chain is cut there without changing it. Texts
        are parted by edges, which are in no run.
        """
        lead = self.field.lead(OUTSIDE)
        places, rows, tokens = [], [], None
        for held, begin, score in self.scores(texts):
            tokens = held
            open_ = (score[:, [OUTSIDE]] - score <= lead)[:, [BEGIN, INSIDE]].any(1)
            open_ &= held.kinds[begin:begin + len(score)] != 0
            places.append(begin + np.flatnonzero(open_))
            rows.append(score[open_])
        if tokens is None or not any(p.size for p in places):
            return tokens, []
        place, score = np.concatenate(places), np.concatenate(rows)
        out = []
        for run in np.split(np.arange(place.size), np.flatnonzero(np.diff(place) != 1) + 1):
            first, last = int(place[run[0]]), int(place[run[-1]])
            out.append((first, self.field.best(
                score[run], OUTSIDE if first and tokens.kinds[first - 1] else None,
                OUTSIDE if tokens.kinds[last + 1] else None)))
        return tokens, out


def labels_of(text: str, places: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """Labels by the fixed patterns; of an assignment only the value is secret."""
    secret = []
    for kind, a, b in spans:
        if kind == "assign":
            m = ASSIGN.match(text, a)
            a = m.start(2) if m else a
        secret.append((a, b))
    out, inside = [], None
    for a, b in places:
        over = next((s for s in secret if s[0] <= a and b <= s[1]), None)
        out.append(OUTSIDE if over is None else INSIDE if over == inside else BEGIN)
        inside = over
    return out


_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/+/+/")


#: What secrets are told by, beside the fixed patterns; {} is the secret.
CONTEXTS = ("password is {}", "the password: {}", "db_pass is {}", "pwd={}", "pass = '{}'",
            "API key {}", "api key: {}", "API key ... {}", "key {}", "token {}", "access token is {}",
            'secret key = "{}"', "login admin / {}", "credentials: {}", "Bearer {}",
            "export KEY={}", "with key={} and")
SIGNS = "!@#$%^&*?+~"


def drawn(draw: random.Random, plain: list[str]) -> str:
    """A secret: long or short, of letters only, with signs, with a prefix, or a pass phrase."""
    def of(alphabet: str, least: int, most: int) -> str:
        return "".join(draw.choice(alphabet) for _ in range(draw.randint(least, most)))

    form = draw.randrange(12)
    if form < 4:
        return of(draw.choice(_ALPHABETS), 16, 44)
    if form < 6:
        return of(_ALPHABETS[3], 7, 11) + draw.choice("0123456789")
    if form < 8:
        return of(_ALPHABETS[3][:52], 14, 40)
    if form < 10:
        head = draw.choice(plain).lower() if draw.random() < 0.5 else of(_ALPHABETS[3], 4, 8)
        return head + of("0123456789", 0, 2) + of(SIGNS, 1, 4) + of(_ALPHABETS[3], 1, 8)
    if form < 11:
        return (of("abcdefghijklmnopqrstuvwxyz", 2, 4) + draw.choice("_-")
                + of(_ALPHABETS[3], 16, 36))
    return "-".join(draw.choice(plain).lower() for _ in range(4)) + of("0123456789", 1, 3)


def planted(text: str, draw: random.Random) -> tuple[str, list[Span]]:
    """The text with a drawn secret, told by one of ``CONTEXTS``, between two of its words."""
    words = text.split(" ")
    plain = [w for w in words if w.isalpha()] or ["page"]
    value = drawn(draw, plain)
    context = draw.choice(CONTEXTS)
    # A long random value is a secret wherever it stands.
    if len(value) >= 20 and value.isalnum() and draw.random() < 0.3:
        context = "{}"
    at = draw.randint(0, len(words))
    head = "".join(w + " " for w in words[:at]) + context[:context.index("{}")]
    tail = context[context.index("{}") + 2:] + draw.choice(["", "", ".", ","])
    return (head + value + tail + "".join(" " + w for w in words[at:]),
            [("crf", len(head), len(head) + len(value))])


def harmless(text: str, draw: random.Random) -> str:
    """The text with ``CONTEXTS`` around ordinary words and numbers."""
    words = text.split(" ")
    plain = [w for w in words if w.isalpha()] or ["page"]
    for _ in range(2):
        word = draw.choice([draw.choice(plain), draw.choice(plain), str(draw.randint(0, 99_999))])
        words.insert(draw.randint(0, len(words)), draw.choice(CONTEXTS).format(word))
    return " ".join(words)


def redrawn(text: str, spans: list[Span], draw: random.Random) -> tuple[str, list[Span]]:
    """The text with each secret replaced by a drawn one, in the same place."""
    out, at, moved = [], 0, []
    size = 0
    plain = [w for w in text.split(" ") if w.isalpha()] or ["page"]
    for kind, a, b in spans:
        if a < at:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, a)
            value = m.start(2) if m else a
        else:
            value = a
        new = drawn(draw, plain)
        if kind != "assign":
            # Without a context only a long random value can be told from a word.
            new = "".join(draw.choice(draw.choice(_ALPHABETS[2:])) for _ in range(24))
        head = text[at:value]
        out += [head, new]
        begin = size + len(head)
        size = begin + len(new)
        moved.append(("crf", begin, size))
        at = b
    out.append(text[at:])
    return "".join(out), moved


def with_addresses(text: str, draw: random.Random) -> str:
    """The text with addresses, paths and dates, made of its words, in some places."""
    words = text.split(" ")
    plain = [w for w in words if w.isalpha()] or ["page"]
    for _ in range(3):
        a, b, c = (draw.choice(plain) for _ in range(3))
        n = draw.randint(1, 9999)
        words.insert(draw.randint(0, len(words)), draw.choice([
            f"https://www.{a}.example.com/{b}/{c}{n}/index.html", f"/{a}/{b}{n}/{c}.txt",
            f"{a}_{b}-{n}.{c}", f"{a}.{b}{n}.example.org", f"2024-{n % 12 + 1:02d}-{n % 28 + 1:02d}",
            f"{a}/{b}/{c}?id={n}&page={n % 7}", f"10.{n % 256}.{n % 99}.{n % 50}/{n % 32}",
        ]))
    return " ".join(words)


def excerpt(text: str, begin: int, end: int) -> str:
    """What stands around a place, cut at blanks."""
    a, b = max(0, begin - REACH), min(len(text), end + REACH)
    if a:
        cut = BLANK.search(text, a, begin)
        a = cut.end() if cut else begin
    if b < len(text):
        b = max([end, *(m.start() for m in BLANK.finditer(text, end, b))])
    return text[a:b]


def train(texts: list[str], seed: int = 42) -> Tagger | None:
    """Fit to excerpts labelled by the fixed patterns, and to copies with drawn secrets.

    Excerpts are taken around every match and around one more place of each text. Each match
    is also learnt with other values in its place, each other excerpt with a secret put into
    it, with addresses, paths and dates, and with words of the kind that tell a secret but
    tell none. What the patterns do not match in the texts is outside. None if the texts hold
    no secret to learn from.
    """
    draw = random.Random(seed)
    chains, labels = [], []

    def add(text: str, spans: list[Span]) -> None:
        places, chain = chain_of(text)
        if chain:
            tags = labels_of(text, places, spans)
            middle = tags.index(BEGIN) if BEGIN in tags else len(tags) // 2
            a = max(0, min(middle - LONGEST // 2, len(tags) - LONGEST))
            chains.append(chain[a:a + LONGEST])
            labels.append(tags[a:a + LONGEST])

    for text in texts:
        for _, a, b in base_spans(text):
            part = excerpt(text, a, b)
            add(part, base_spans(part))
            for _ in range(3):
                add(*redrawn(part, base_spans(part), draw))
    if not any(BEGIN in tags for tags in labels):
        return None
    for text in texts:
        at = draw.randint(0, len(text))
        part = excerpt(text, at, at)
        if not base_spans(part):
            add(part, [])
            add(*planted(part, draw))
            other = draw.choice([with_addresses, harmless])(part, draw)
            add(other, base_spans(other))
    seen = Counter(f for chain in chains for token in chain for f in token)
    names = {f: i for i, f in enumerate(sorted(f for f in seen if seen[f] >= LEAST), 1)}
    numbers = [[[names[f] for f in token if f in names] for token in chain] for chain in chains]
    return Tagger(ChainCRF(3, len(names) + 1).fit(numbers, labels), names)


def crf_spans(text: str, model: Tagger, taken: list[Span]) -> list[Span]:
    """Spans tagged by the model that no span of ``taken`` holds whole."""
    return next(crf_spans_of([text], model, [taken]))


def crf_spans_of(texts: list[str], model: Tagger,
                 taken: list[list[Span]]) -> Iterator[list[Span]]:
    """``crf_spans`` of each text. Short texts are tagged together, about ``STEP`` characters."""
    begin, size = 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size < STEP and i < len(texts):
            continue
        tokens, runs = model.labels(*texts[begin:i])
        found: list[list[Span]] = [[] for _ in range(begin, i)]
        for first, tags in runs:
            span, spans = None, found[int(tokens.of[first])]
            for at, tag in enumerate([*tags, OUTSIDE], first):
                if span and tag != INSIDE:
                    spans.append(("crf", *span))
                    span = None
                if tag == BEGIN or (tag == INSIDE and not span):
                    span = (int(tokens.at[at]), int(tokens.to[at]))
                elif tag == INSIDE:
                    span = (span[0], int(tokens.to[at]))
        for spans, held in zip(found, taken[begin:i], strict=True):
            yield [s for s in spans if not any(a <= s[1] and s[2] <= b for _, a, b in held)]
        begin, size = i, 0


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, train_rows: int = 800, train_chars: int = 20_000,
                 seed: int = 42) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf of every row.

    Spans are kind:start:end in code points, end exclusive. The field is fitted, in the
    driver, to a sample of about ``train_rows`` texts drawn by a hash of doc_id, of each at most
    ``train_chars`` characters from a drawn place on; every text is then scanned whole, in
    place, without a shuffle: each of its tokens is tagged, and spans that lie within one of a
    fixed pattern are left out. A null text is empty and has no spans.
    Repeated rows are scanned alike; extra columns are ignored; an empty table gives an empty
    result. Without any secret in the sample only the fixed patterns are applied.
    """
    rows = pick(docs, "doc_id", "text")
    begin = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.greatest(
        F.lit(1), F.char_length("text") - train_chars + 1)).cast("int") + 1
    sample = sample_rows(rows.filter("text IS NOT NULL").withColumn(
        "text", F.substring("text", begin, F.lit(train_chars))), train_rows, seed)
    model = train([r["text"] for r in sample], seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch[1].to_pylist()
            base = spans = [base_spans(text) for text in texts]
            if model:
                added = crf_spans_of(texts, model, base)
                spans = [in_order(b + a) for b, a in zip(base, added, strict=True)]
            counts = [[sum(s[0] == kind for s in found) for found in spans] for kind in KINDS]
            digest = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch[0], *[pa.array(np.array(c, np.int64)) for c in counts[:3]],
                 pa.array(digest, pa.string()), pa.array(map(_joined, spans), pa.string()),
                 pa.array(np.array(counts[3], np.int64))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"])

    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_assign bigint, "
              "n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint")
    return rows.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(run, schema)
