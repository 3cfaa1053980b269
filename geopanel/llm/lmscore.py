"""Language-model scores of documents: byte contexts (PPM), and words for comparison."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm import ppm
from geopanel.llm.common import pick, shared_table

#: Bytes behind their whole context from one in so many training bytes on, at most so many, are
#: known to every task. All others are looked up by a join.
RESOLUTION = 1 << 21
#: Contexts of fewer bytes are known to every task that works out rare bytes (at most 256 ** 3
#: nodes); those that end with the same so many bytes are worked out together.
TAIL = 3
#: Keys that a task works out at a time.
PART = 1 << 20
#: Words from one in so many training tokens on, at most so many, are known to every task.
#: All others are looked up by a join.
HEAD = 1 << 17
#: Different words that a task counts before it hands its table on.
WORDS = 1 << 20
#: Words of texts that are looked up in one go.
TOGETHER = 1 << 17
#: What a text ends with, as a token; no word is empty.
END = b""

WORD_KIND, BYTE_KIND = 0, 1


def word_key(word: bytes) -> int:
    """Words are counted by 64-bit hashes, signed as Spark's BIGINT."""
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def word_keys(words: Iterable[bytes], size: int) -> np.ndarray:
    """``word_key`` of many words. To hash one is cheaper than to find it among many."""
    key = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, size)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


class WordLogs:
    """Logarithms of the probability of frequent words."""

    def __init__(self, key: np.ndarray, log: np.ndarray):
        self.known, self.log = ppm.Table(key.view(np.uint64)), log

    def score(self, found: list[Counter]) -> tuple[np.ndarray, ...]:
        """(frequent tokens of each text, the sum of their logarithms, how many other words it
        has; the keys of these, text by text, and how often each occurs there)."""
        each = np.fromiter(map(len, found), np.int64, len(found))
        size = int(each.sum())
        key = word_keys(chain.from_iterable(found), size)
        times = np.fromiter(chain.from_iterable(f.values() for f in found), np.int64, size)
        owner = np.repeat(np.arange(each.size), each)
        number = self.known.find(key.view(np.uint64))
        rare = number < 0
        known, n = owner[~rare], times[~rare]
        return (np.bincount(known, n, each.size).astype(np.int64),
                np.bincount(known, n * self.log[number[~rare]], each.size),
                np.bincount(owner[rare], minlength=each.size), key[rare], times[rare])


def _counted(order: int):
    """Counts of words and of byte keys of a partition of training texts."""

    def table(kind: int, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, key.size, 1 << 17):
            part = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(key[part].size, kind, np.int32)), pa.array(key[part]),
                 pa.array(n[part])], names=["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {WORD_KIND: ppm.KeyCounter(WORDS), BYTE_KIND: ppm.KeyCounter()}

        def add(kind: int, key: np.ndarray) -> Iterator[pa.RecordBatch]:
            full = counters[kind].add(key)
            if full:
                yield from table(kind, full[0].view(np.int64), full[1])

        for batch in batches:
            bodies = batch[0].to_pylist()
            for a, b in ppm.batches_of(bodies):
                tokens = [token for body in bodies[a:b] for token in (*body.lower().split(), END)]
                yield from add(WORD_KIND, word_keys(tokens, len(tokens)))
                data, places, _ = ppm.coded(bodies[a:b], order)
                yield from add(BYTE_KIND, ppm.keys(data, places, order))
        for kind, counter in counters.items():
            full = counter.rest()
            if full:
                yield from table(kind, full[0].view(np.int64), full[1])

    return run


def corpus_counts(train: DataFrame, order: int = ppm.ORDER) -> DataFrame:
    """(kind, key, n) of all training texts: words, and byte keys of the full order."""
    partial = train.select("body").mapInArrow(_counted(order), "kind int, key bigint, n bigint")
    return shared_table(partial.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts", "zstd")


def _arrays(df: DataFrame, *names: str) -> list[np.ndarray]:
    held = df.select(*names).toArrow().combine_chunks()
    return [held[n].to_numpy() for n in names]


def byte_head(counts: DataFrame, order: int = ppm.ORDER) -> ppm.Head:
    """The frequent byte keys, each with its probability behind its whole context."""
    full = counts.filter(F.col("kind") == BYTE_KIND).select("key", "n")
    total = full.agg(F.sum("n")).first()[0] or 0
    least = -(-total // RESOLUTION)
    key, n = _arrays(full.filter(F.col("n") >= least), "key", "n")
    context, context_n, kinds = _arrays(
        full.groupBy(F.shiftrightunsigned("key", 8).alias("key"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.max("n").alias("top"))
        .filter(F.col("top") >= least), "key", "n", "kinds")
    key = key.astype(np.uint64)
    at = ppm.Table(context.astype(np.uint64)).find(key >> np.uint64(8))
    return ppm.Head(key, np.log(n) - np.log(context_n + kinds)[at], order)


def byte_logs(counts: DataFrame, asked: DataFrame, order: int = ppm.ORDER) -> DataFrame:
    """(key, log): natural logarithm of the probability of the byte keys in ``asked``.

    By all contexts of the training texts. What a key can be looked up in ends with the same
    bytes, so that keys and counts are dealt by them and each task has a part of the trie;
    contexts shorter than those bytes are broadcast.
    """
    full = counts.filter(F.col("kind") == BYTE_KIND).select("key", "n")
    tail = min(TAIL, order)
    mask = F.lit((1 << (8 * tail)) - 1).cast("bigint")
    short_key, short_n = _arrays(full.groupBy(F.col("key").bitwiseAND(mask).alias("key")).agg(
        F.sum("n").alias("n")), "key", "n")
    short = counts.sparkSession.sparkContext.broadcast(
        ppm.levels(short_key.astype(np.uint64), short_n, range(tail, 0, -1)))

    def part(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        known = n > 0
        long = ppm.levels(key[known], n[known], range(order + 1, tail, -1))
        model = ppm.Trie.build(
            *[np.concatenate(both) for both in zip(long, short.value, strict=True)], order)
        wanted = key[~known]
        return pa.RecordBatch.from_arrays(
            [pa.array(wanted.view(np.int64)), pa.array(model.logs(wanted))],
            names=["key", "log"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch["key"].to_numpy().view(np.uint64), batch["n"].to_numpy()))
            size += batch.num_rows
            if size > PART:
                key, n = (np.concatenate(x) for x in zip(*held, strict=True))
                ends = (key >> np.uint64(8)) & np.uint64((1 << (8 * tail)) - 1)
                # The last tail may go on in the next batch.
                whole = int(np.argmax(ends == ends[-1]))
                if whole:
                    yield part(key[:whole], n[:whole])
                held, size = [(key[whole:], n[whole:])], key.size - whole
        if size:
            yield part(*(np.concatenate(x) for x in zip(*held, strict=True)))

    # Dealt and sorted by the tail of the key, which is not shuffled beside it.
    ends_of = F.shiftrightunsigned("key", 8).bitwiseAND(mask)
    both = full.union(asked.select("key", F.lit(0).cast("bigint")))
    return both.repartition(ends_of).sortWithinPartitions(ends_of).mapInArrow(
        run, "key bigint, log double")


def score_documents(docs: DataFrame, order: int = ppm.ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Trained on the rows whose crc32 of doc_id as text leaves no remainder 1 by 5 (rows
    without doc_id too), all of them whole. score is the log10 probability of the text, A-Z
    lower-cased, and its end, by all byte contexts of the training texts; base_score that of its words, and an end, by
    their smoothed frequency. bits_per_byte is the code length of score over bytes and end.

    A null or empty text is its end alone. Repeated rows count, and are scored, each for
    itself. Extra columns are ignored; an empty table gives an empty result.
    """
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1,
                   F.lit(False)).alias("held_out"))
    counts = corpus_counts(rows.filter("NOT held_out"), order)
    words = counts.filter(F.col("kind") == WORD_KIND)
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head_key, head_n = _arrays(
        words.filter(F.col("n") * HEAD >= total).select("key", "n"), "key", "n")
    spark = docs.sparkSession
    bottom = total + 0.5 * (kinds + 1)
    model = spark.sparkContext.broadcast(
        (byte_head(counts, order), WordLogs(head_key, np.log10((head_n + 0.5) / bottom))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_table, word_logs = model.value
        for batch in batches:
            bodies = batch["body"].to_pylist()
            tokens, size, found, held, parts = [], [], [], 0, []
            for at, body in enumerate(bodies):
                found.append(Counter(body.lower().split()))
                found[-1][END] = 1
                tokens.append(found[-1].total())
                size.append(len(body) + 1)
                held += len(found[-1])
                if held >= TOGETHER or at + 1 == len(bodies):
                    parts.append(word_logs.score(found))
                    found, held = [], 0
            if not bodies:
                continue
            known, base, tail_sizes, tails, times = map(np.concatenate, zip(*parts, strict=True))
            part, more, rare, reps = byte_table.score(bodies)
            byte_ends = pa.array(np.r_[0, np.cumsum(more)], pa.int32())
            offsets = pa.array(np.r_[0, np.cumsum(tail_sizes)], pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch["row"], batch["doc_id"], batch["held_out"], pa.array(tokens, pa.int64()),
                pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(part),
                pa.array(size, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(tails, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                pa.ListArray.from_arrays(byte_ends, pa.array(rare.view(np.int64))),
                pa.ListArray.from_arrays(byte_ends, pa.array(reps, pa.int32())),
            ], names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "part", "size",
                      "tail", "times", "rare", "reps"])

    key = rows.schema["doc_id"].dataType.simpleString()
    scored = shared_table(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, f"row bigint, doc_id {key}, held_out boolean, n_tokens bigint, known bigint, "
             "base double, part double, size bigint, tail array<bigint>, times array<bigint>, "
             "rare array<bigint>, reps array<int>"),
        "scored", "zstd")
    rare = scored.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "row", F.col("t.tail").alias("key"), F.col("t.times").alias("times"))
    met = rare.join(words.select("key", "n"), "key", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(bottom)))
        .alias("rest"))
    bytes_ = scored.select("row", F.explode(F.arrays_zip("rare", "reps")).alias("t")).select(
        "row", F.col("t.rare").alias("key"), F.col("t.reps").alias("reps"))
    logs = shared_table(byte_logs(counts, bytes_.select("key").distinct(), order), "byte-logs", "zstd")
    byte_sums = bytes_.join(logs, "key").groupBy("row").agg(
        F.sum(F.col("reps") * F.col("log")).alias("logs"))
    out = scored.drop("tail", "times", "rare", "reps").join(sums, "row", "left").join(
        byte_sums, "row", "left").withColumn(
        "score", (F.col("part") + F.coalesce("logs", F.lit(0.0))) / float(np.log(10)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0)))
        .alias("n_known"), F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.col("size")).alias("bits_per_byte"))
