"""Quality rules per document, with verdicts per host from shrunk failure rates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import hold, in_batches, pick, shared_table

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
WINDOW = 8
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Rules beside the base ones; each is true where a document fails. All whole numbers.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "letters": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}
BASE = ("short", "repeats")

#: Strength of a prior where hosts don't differ, in documents.
MOST = 1e6


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found at least twice in the text."""
    windows = len(words) - width + 1
    if windows < 2:
        return 0
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    key = np.zeros(windows, np.uint64)
    for i in range(width):
        key = key * _FACTOR + numbers[i:i + windows]
    # Stable, so that equal keys stay in text order.
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not same.size:
        return 0
    left, right = order[same], order[same + 1]
    for i in range(width):
        if (numbers[left + i] != numbers[right + i]).any():
            return _repeated_exactly(numbers, windows, width)
    return _covered(np.concatenate([left, right]), len(words), width)


def _covered(starts: np.ndarray, n: int, width: int) -> int:
    begin = np.zeros(n + 1, np.int64)
    begin[np.unique(starts)] = 1
    ends = np.zeros(n + 1, np.int64)
    ends[np.unique(starts) + width] = 1
    return int((np.cumsum(begin - ends)[:n] > 0).sum())


def _repeated_exactly(numbers: np.ndarray, windows: int, width: int) -> int:
    """The same without keys, for a text in which two windows share a key by chance."""
    rows = np.lib.stride_tricks.sliding_window_view(numbers, width)
    _, of, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    return _covered(np.flatnonzero(times[of.ravel()] > 1), windows + width - 1, width)


def measures(body: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of a text."""
    words = body.split()
    lines = [line for line in body.split(b"\n") if line.strip()]
    chars = len(body.decode("utf-8", "replace")) - sum(body.count(c) for c in BLANKS)
    return (len(words), chars, sum(body.count(c) for c in SYMBOLS), len(lines),
            len(lines) - len(set(lines)), repeated_words(words))


_NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = np.array([measures(b.as_py()) for b in batch["body"]], np.int64).T
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], batch["host"], *map(pa.array, found)],
        names=["doc_id", "host", *_NAMES])


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the six measures of every row. A null text counts as empty."""
    rows = pick(docs, "doc_id", "text", host).select(
        "doc_id", F.col(host).cast("string").alias("host"),
        F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, host string, " + ", ".join(
        f"{n} bigint" for n in _NAMES)
    return rows.mapInArrow(in_batches(_measured), schema)


def _prior(hosts: int, docs: float | None, squares: float | None, bad: float | None,
           within: float | None, limit: float) -> tuple[float, float]:
    """Mean and strength of a rule's prior; ``within``: sum of bad^2 / n over hosts."""
    if not docs:
        return 0.0, MOST
    mean = bad / docs
    spread = mean * (1 - mean)
    # What the weighted squares of host rates would exceed the drawing by at a correlation of 1.
    room = docs - squares / docs - (hosts - 1)
    surplus = (within - bad * mean) / spread - (hosts - 1) if spread > 0 else 0.0
    strength = room / surplus - 1 if room > 0 and surplus > 0 else MOST
    least = max(1.0, 1 / (limit - mean)) if mean < limit else 1.0
    return mean, min(max(strength, least), MOST)


def host_verdicts(measured: DataFrame, limit: float = 0.5) -> DataFrame:
    """One row per host: n_docs, the shrunk failure rate of each rule, host_failed.

    Every rule has a beta prior fitted to the failures of all hosts. Its mean m is all failures
    over all documents. Its strength is 1 / c - 1, c being the correlation of documents of one
    host: the spread of host rates, weighted by documents, less what drawing so few documents
    spreads them anyway. Without such a surplus, as where every host has one document, the
    strength is a million. It is at least 1 and, as long as m is below ``limit``, at least
    1 / (limit - m), so that a single document never condemns its host. A host's rate is its
    posterior mean. Hosts without name are one host. A host fails if any rate exceeds ``limit``.
    """
    counted = shared_table(measured.groupBy("host").agg(
        F.count("*").alias("n_docs"),
        *[F.count_if(F.expr(rule)).alias(f"bad_{name}") for name, rule in RULES.items()],
    ), "hosts")
    size = F.col("n_docs").cast("double")
    moments = counted.agg(
        F.count("*").alias("hosts"), F.sum(size).alias("docs"), F.sum(size * size).alias("squares"),
        *[m for name in RULES for m in (
            F.sum(F.col(f"bad_{name}").cast("double")).alias(f"bad_{name}"),
            F.sum(F.col(f"bad_{name}").cast("double") * F.col(f"bad_{name}") / size)
            .alias(f"within_{name}"))]).first().asDict()
    rates = {}
    for name in RULES:
        mean, strength = _prior(moments["hosts"], moments["docs"], moments["squares"],
                                moments[f"bad_{name}"], moments[f"within_{name}"], limit)
        rates[f"rate_{name}"] = (F.col(f"bad_{name}") + F.lit(mean * strength)) / (
            size + F.lit(strength))
    return counted.select("host", "n_docs", *[c.alias(n) for n, c in rates.items()]).withColumn(
        "host_failed", F.greatest(*rates) > limit)


def judge(docs: DataFrame, host: str = "source", limit: float = 0.5) -> DataFrame:
    """Per row of ``docs``: the measures, base_failed, host_failed and kept.

    base_failed: a base rule fails. On a host that fails, a document is kept only if it
    breaks none of ``RULES``; elsewhere only the base rules count. Null text: empty, so it
    fails. Null host: one host of its own. Repeated rows are judged alike. Extra columns are
    ignored; an empty table gives an empty result.
    """
    rows = shared_table(measure(docs, host), "measures")
    verdicts = shared_table(host_verdicts(rows, limit), "verdicts").withColumnRenamed(
        "host", "of_host")
    joined = rows.join(verdicts, rows["host"].eqNullSafe(F.col("of_host")))
    failed = " OR ".join(f"({RULES[name]})" for name in BASE)
    broken = " OR ".join(f"({rule})" for rule in RULES.values())
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(failed).alias("base_failed"),
        F.expr(f"NOT ({failed}) AND NOT (host_failed AND ({broken}))").alias("kept"),
        "n_lines", "host", "host_failed",
        F.greatest(*[f"rate_{name}" for name in RULES]).alias("host_rate"))


def keep_good(docs: DataFrame, host: str = "source", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all columns.

    A doc_id goes if any of its rows is rejected; rows without doc_id stay unjudged.
    """
    held, back = hold(docs, "doc_id", "text", host)
    gone = judge(held, host, limit).filter("NOT kept").select("doc_id").distinct()
    return back(held.join(gone, "doc_id", "left_anti"))
