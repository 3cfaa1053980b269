from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from geopanel.llm import gru, langid

SF = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    draw = np.random.default_rng(0)
    model = gru.ByteTagger(3, units=3, seed=1)
    for p in model.parameters():
        p[...] = draw.normal(0, 0.2, p.shape)
    for layer in (model.ahead, model.behind):
        layer.take[:6] += 0.5
    codes = draw.integers(97, 103, (5, 4)).astype(np.uint8)
    letters = np.ones((5, 4), np.float32)
    letters[-1, 0] = 0
    label = np.array([0, 1, 2, 1])
    # Double precision, so that differences mean something.
    for owner, name in ((model.ahead, "take"), (model.ahead, "back"), (model.ahead, "bias"),
                        (model.behind, "take"), (model.behind, "back"), (model.behind, "bias"),
                        (model, "out"), (model, "base")):
        setattr(owner, name, getattr(owner, name).astype(np.float64))
    _, grads = model.gradients(codes, letters, label)
    step = 1e-4
    for p, g in zip(model.parameters(), grads, strict=True):
        flat = p.reshape(-1)
        where = [97, 99, 100, 256 + 98, 7 * 256 + 101] if p.shape[-1] == 256 else range(flat.size)
        for i in where:
            old = flat[i]
            flat[i] = old + step
            up = model.gradients(codes, letters, label)[0]
            flat[i] = old - step
            down = model.gradients(codes, letters, label)[0]
            flat[i] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 2e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_but_the_text_matters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    held = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    blind = train.union(held.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(blind).collect()}
    assert {d: v[0] for d, v in a.items()} == {d: v[0] for d, v in b.items()}


def test_odd_rows(odd):
    found = langid.identify(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found}
    for d in (1, 2, 3, 10):
        assert (by_id[d].lang_pred, by_id[d].score) == ("und", 0.0)
    assert by_id[8].lang_pred in ("en", "de", "fr")
    assert langid.identify(odd.limit(0)).collect() == []
    none = langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_letters():
    assert langid.has_letter("é".encode()) and langid.has_letter(b"12 a")
    assert not langid.has_letter("12 – … 😀".encode()) and not langid.has_letter(b"")
