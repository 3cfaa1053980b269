"""Language of documents by a bidirectional recurrent network over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import pick
from geopanel.llm.gru import LETTER, SIDE, ByteTagger, windows_of

#: Training texts per language, and characters of each, from a seeded place in the text.
TEXTS, CHARACTERS = 500, 512
UNKNOWN = "und"


def has_letter(body: bytes) -> bool:
    """Does a UTF-8 text hold any letter?"""
    if not LETTER[np.frombuffer(body, np.uint8)].any():
        return False
    text = body.decode("utf-8", "replace")
    return any(c.isalpha() for c in text)


def train(train_rows: DataFrame, texts: int = TEXTS, seed: int = 42,
          ) -> tuple[ByteTagger, list[str]] | None:
    """Fit to about ``texts`` rows (doc_id, text, lang) of each language.

    Rows are chosen by a hash of their text; nothing but text and lang is used. None if
    there are no labelled texts.
    """
    counts = {r["lang"]: r["count"] for r in train_rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    scale = 1 << 30
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, min(scale, -(-scale * texts // n))).otherwise(share)
    mark = F.xxhash64(F.lit(seed), "text")
    start = F.pmod(F.shiftright(mark, 31), F.greatest(
        F.char_length("text") - CHARACTERS + 1, F.lit(1))).cast("int") + 1
    chosen = train_rows.filter(F.pmod(mark, F.lit(scale)) < share).select(
        "lang", F.substring(F.col("text"), start, F.lit(CHARACTERS)).alias("part"))
    sample = sorted(tuple(r) for r in chosen.limit(2 * texts * len(counts)).collect())
    names = sorted({lang for lang, _ in sample})
    if not names:
        return None
    windows, count = windows_of([part.encode("utf-8", "replace").lower() for _, part in sample])
    label = np.repeat([names.index(lang) for lang, _ in sample], count)
    return ByteTagger(len(names), seed=seed).fit(windows, label, seed=seed), names


def label_batch(model: ByteTagger, bodies: list[bytes]) -> np.ndarray:
    """(texts, labels): mean probability of each label over the letters of each text."""
    windows, count = windows_of([b.lower() for b in bodies])
    letters = LETTER[windows]
    pooled = np.zeros((len(windows), model.out.shape[0]))
    for at in range(0, len(windows), SIDE):
        codes = np.ascontiguousarray(windows[at:at + SIDE].T)
        live = np.ascontiguousarray(letters[at:at + SIDE].T).astype(np.float32)
        pooled[at:at + SIDE] = model.pooled(codes, live).T
    owner = np.repeat(np.arange(len(bodies)), count)
    sums = np.stack([np.bincount(owner, column, len(bodies)) for column in pooled.T], 1)
    n = np.bincount(owner, letters.sum(1), len(bodies))
    return sums / np.maximum(n, 1)[:, None]


def identify(docs: DataFrame, texts: int = TEXTS, seed: int = 42,
             batch_bytes: int = 1 << 22) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Learns from text and lang of rows with a language whose crc32 of doc_id as text leaves
    no remainder 1 by 3 (rows without doc_id too). The network runs over windows of 64 bytes,
    each from rest in both directions, labels every byte, and the label with the greatest mean
    probability over all letters of the text wins (ties: the first name); that mean is score.
    Texts that are null or have no letter are 'und' with score 0.

    The model is fitted in the driver and goes out with the tasks (a few thousand numbers);
    documents are labelled where they are read. Repeated rows are labelled alike; extra
    columns are ignored; an empty table gives an empty result; without any labelled row all
    texts are 'und'.
    """
    rows = pick(docs, "doc_id", "text", "lang").withColumn("held_out", F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)))
    fitted = train(rows.filter("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")
                   .filter(F.col("text").rlike(r"\p{L}")), texts, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch[2].to_pylist()
            langs, scores = [], []
            begin, held = 0, 0
            for i, body in enumerate(bodies):
                held += len(body)
                if held >= batch_bytes or i + 1 == len(bodies):
                    some = bodies[begin:i + 1]
                    means = label_batch(fitted[0], some) if fitted else np.zeros((len(some), 1))
                    for b, row in zip(some, means, strict=True):
                        best = int(row.argmax())
                        known = fitted is not None and has_letter(b)
                        langs.append(fitted[1][best] if known else UNKNOWN)
                        scores.append(min(1.0, float(row[best])) if known else 0.0)
                    begin, held = i + 1, 0
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.select(
        "doc_id", "held_out", F.coalesce("text", F.lit("")).cast("binary").alias("body"),
    ).mapInArrow(run, f"doc_id {key}, held_out boolean, lang_pred string, score double")
