"""What the operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.session import shared_folder

#: ASCII blanks; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, whatever else the table holds.

    An exact spelling wins over one that differs in case, the first column over later ones,
    so extra columns with clashing names do no harm. A missing column is an error.
    """
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    chosen = []
    for name in names:
        found = [i for i, c in enumerate(columns) if c == name]
        found += [i for i, c in enumerate(columns) if c.lower() == name.lower()]
        if not found:
            raise ValueError(f"no column {name} among {columns}")
        chosen.append(F.col(f"c{found[0]}").alias(name))
    return plain.select(*chosen)


def shared_table(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a frame to the folder all executors share and read it again.

    Cuts the lineage: a lost executor costs its own tasks, not the stages behind them. The
    files go when the session ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"geopanel-{name}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Apply a function to every Arrow batch of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def utf8(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text as UTF-8 bytes; a missing text is empty."""
    return df.select(key, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))


def sample_rows(df: DataFrame, rows: int, seed: int, key: str = "doc_id") -> list:
    """About ``rows`` rows (never more than twice that), chosen by a hash of the key."""
    total = df.count()
    if not total:
        return []
    scale = 1 << 30
    cut = min(scale, math.ceil(scale * rows / total))
    chosen = df.filter(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(scale)) < cut)
    return sorted(chosen.limit(2 * rows).collect(), key=lambda r: (r[key] is None, r[key] or 0))


def hold(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(frame, back): all columns, of which only ``names`` keep their name, chosen as in ``pick``.

    ``back(out, *more)`` gives the columns of ``df`` in their order and with their names, with
    the values that ``out`` has, and ``more`` of its columns behind them; those replace columns
    of ``df`` with the same name.
    """
    columns, inner = df.columns, [f"__held{i}" for i in range(len(df.columns))]
    for name in names:
        found = [i for i, c in enumerate(columns) if c == name]
        found += [i for i, c in enumerate(columns) if c.lower() == name.lower()]
        if not found:
            raise ValueError(f"no column {name} among {columns}")
        inner[found[0]] = name

    def back(out: DataFrame, *more: str) -> DataFrame:
        kept = [(i, c) for i, c in zip(inner, columns, strict=True) if c not in more]
        return out.select(*[i for i, _ in kept], *more).toDF(*[c for _, c in kept], *more)

    return df.toDF(*inner), back
