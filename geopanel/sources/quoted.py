"""Texts cut at a separator outside of quotes, split over tasks wherever the cuts fall.

Whether a separator stands in quotes depends on all quotes before it in its file. Two passes
settle that without reading a file in one task: the first adds up the quotes of every block
of a file, and a prefix sum over the blocks tells which begin inside quotes; the second cuts
each block from there. Only what is left at the two ends of a block is put together across
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A piece is a whole record, ends one, begins one, or lies within one.
WHOLE, ENDS, BEGINS, WITHIN = range(4)


def _plain(value: Column, escapes: bool) -> Column:
    """The text without escaped characters, if a backslash escapes."""
    return F.regexp_replace(value, r"(?s)\\.", "") if escapes else value


def quoted_records(
    spark: SparkSession, path: str, separator: str, escapes: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(file, at, value) of all records, and (file, open) of all files.

    Records end at a one-character ``separator`` outside of double quotes, which is cut off.
    A doubled quote in quotes, or with ``escapes`` one behind a backslash, does not end them.
    ``at`` (block, number in it) orders the records of a file, the first has (0, 0). ``open``
    says that a file's last record lacks its separator. Files are UTF-8. The driver holds 16
    bytes for every block that begins in quotes.
    """
    text = spark.read.text(path, lineSep=separator).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"))
    plain = _plain(F.col("value"), escapes)
    quotes = F.char_length(plain) - F.char_length(F.replace(plain, F.lit('"'), F.lit("")))
    blocks = text.groupBy("file", "block").agg(
        F.pmod(F.sum(quotes), F.lit(2)).alias("odd"), F.max("size").alias("size"),
        F.sum(F.octet_length("value") + 1).alias("bytes"))
    before = F.sum("odd").over(
        W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    inside = blocks.withColumn("before", before).filter("before % 2 = 1").select(
        F.xxhash64("file").alias("file"), "block").collect()
    begin_inside = spark.sparkContext.broadcast(frozenset((r.file, r.block) for r in inside))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(separator, begin_inside.value)
        for batch in batches:
            value = batch.column("value")
            marks = pc.replace_substring_regex(value, r"(?s)\\.", "") if escapes else value
            odd = pc.count_substring(marks, '"').to_numpy(zero_copy_only=False) % 2 == 1
            cutter.add(value.to_pylist(), odd.tolist(), batch.column("key").to_pylist(),
                       batch.column("file").to_pylist(), batch.column("block").to_pylist())
            yield cutter.pieces()
        cutter.end_block()
        yield cutter.pieces()

    pieces = text.select("value", F.xxhash64("file").alias("key"), "file", "block").mapInArrow(
        cut, "file string, block bigint, number bigint, kind int, value string")
    whole = pieces.filter(F.col("kind") == WHOLE)
    ends = _joined(pieces.filter(F.col("kind") != WHOLE), separator)
    records = whole.drop("kind").unionByName(ends).select(
        "file", F.struct("block", "number").alias("at"), "value")
    files = blocks.groupBy("file").agg(
        (F.sum("bytes") > F.max("size")).alias("open"))
    return records, files


class _Cutter:
    """Pieces of the blocks that a task reads, one block after the other."""

    def __init__(self, separator: str, begin_inside: frozenset):
        self.separator, self.begin_inside = separator, begin_inside
        self.place: tuple | None = None
        self.number, self.odd, self.inherited = 0, False, False
        self.held: list[str] = []
        self.out: list[tuple] = []

    def add(self, values, odd, keys, files, blocks) -> None:
        for value, flips, key, file, block in zip(values, odd, keys, files, blocks, strict=True):
            if (file, block) != self.place:
                self.end_block()
                self.place, self.number = (file, block), 0
                # What begins inside quotes goes on a record of a block before.
                self.odd = self.inherited = (key, block) in self.begin_inside
            self.held.append(value)
            self.odd ^= flips
            if not self.odd:
                self._piece(ENDS if self.inherited else WHOLE)

    def end_block(self) -> None:
        if self.held:
            self._piece(WITHIN if self.inherited else BEGINS)

    def _piece(self, kind: int) -> None:
        self.out.append((*self.place, self.number, kind, self.separator.join(self.held)))
        self.number, self.inherited, self.held = self.number + 1, False, []

    def pieces(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) or [()] * 5
        self.out = []
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["file", "block", "number", "kind", "value"])


def _joined(pieces: DataFrame, separator: str) -> DataFrame:
    """Records that go over blocks: at most two pieces of every block."""
    by = W.partitionBy("file").orderBy("block", "number").rowsBetween(W.unboundedPreceding, 0)
    nth = F.sum(F.when(F.col("kind") == BEGINS, 1).otherwise(0)).over(by)
    parts = F.array_sort(F.collect_list(F.struct("block", "number", "value")))
    return pieces.withColumn("nth", nth).groupBy("file", "nth").agg(parts.alias("parts")).select(
        "file", F.col("parts")[0]["block"].alias("block"),
        F.col("parts")[0]["number"].alias("number"),
        F.array_join(F.transform("parts", lambda p: p["value"]), separator).alias("value"))
