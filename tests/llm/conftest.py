from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{i % 701}" for i in range(30_000))


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text, lang, source) tuples."""

    def build(rows, schema=SCHEMA):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] else None) for r in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, and clashing columns."""
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"),
        (4, LONG, "en", "a"), (4, LONG, "en", "a"), (None, "no number here", "en", None),
        (None, None, None, None), (7, "Ünïcode – текст 漢字", "de", "b"), (8, "x", "fr", "b"),
        (9, "a b", None, "b"), (10, "|*#$ <> %%%", "en", ""),
    ]
    extra = ("TEXT", "print", "fingerprint", "component_id", "gone", "n_words", "host", "row",
             "epoch", "sequence_id", "length", "kept")
    frame = spark.createDataFrame(
        [(*r, 5) for r in rows], "doc_id bigint, text string, lang string, source string, "
                                 "n_chars bigint")
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit("clash").alias(name) for name in extra])
