"""Joins with the matching rules the tables rely on.

Missing keys match each other, and where one side must have unique keys a repeated one is
an error. No join here carries a broadcast hint: the optimizer broadcasts a side whose size
it knows to be small, and adaptive execution splits hot keys of the left joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geopanel.functions import single_value


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` put together by its keys, or an error if one occurs twice; NULL is a key.

    The check is part of the aggregation that the rows come out of: ``df`` is read once.
    """
    values = [c for c in df.columns if c not in keys]
    once = F.expr(f"assert_true(count(1) < 2, 'a key occurs twice: {', '.join(keys)}')")
    return df.groupBy(*keys).agg(
        once.alias("__once"), *[_only(df, c) for c in values]
    ).filter(F.col("__once").isNull()).select(*df.columns)


def _only(df: DataFrame, name: str) -> Column:
    """The value of a group of one row: a maximum where that is a hash aggregation."""
    hashed = _hashed(df.schema[name].dataType)
    return (F.max(name) if hashed else F.first(name, ignorenulls=True)).alias(name)


def full_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], nullable: bool = True,
    check: bool = True,
) -> DataFrame:
    """Full outer join on keys that are unique on both sides, keys coalesced.

    NULL keys match NULL keys. A repeated key is an error, found by the one aggregation that
    also matches the sides (``combine_sources``). Say ``check=False`` only for sides that are
    unique by how they were made, by a grouping on the keys for instance: they are joined
    by an equi-join, and ``nullable=False`` for keys that are never NULL lets it reuse a
    side's partitioning.
    """
    if check:
        return combine_sources([left, right], keys)
    if not nullable:
        return left.join(right, list(keys), "full")
    lhs = left.withColumnsRenamed({k: f"__l_{k}" for k in keys})
    rhs = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = [F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    rest = [c for df in (left, right) for c in df.columns if c not in keys]
    return lhs.join(rhs, condition, "full").select(
        *[F.coalesce(f"__l_{k}", f"__r_{k}").alias(k) for k in keys], *rest
    )


def left_lookup(
    df: DataFrame, lookup: DataFrame, on: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Left join; ``on`` maps key of ``df`` -> key of ``lookup``; lookup keys are dropped.

    NULL keys match NULL keys; a repeated key of ``lookup`` is an error.
    """
    pairs = on if isinstance(on, Mapping) else {k: k for k in on}
    right = unique_by(lookup, list(pairs.values())).withColumnsRenamed(
        {k: f"__k_{k}" for k in pairs.values()}
    )
    condition = [F.col(k).eqNullSafe(F.col(f"__k_{r}")) for k, r in pairs.items()]
    return df.join(right, condition, "left").drop(*[f"__k_{r}" for r in pairs.values()])


def left_join_unique(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to rows that must be unique by all keys, with one shuffle of either side.

    NULL keys match NULL keys. The key is one struct, so the join reuses the partitioning of the
    aggregation that checks ``other``. For keys that are (nearly) unique in ``df`` too: a hot
    key could not be split here; see ``left_lookup``.
    """
    whole = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    kinds = {k: df.schema[k].dataType for k in keys}
    right = other.withColumns({k: F.col(k).cast(kind) for k, kind in kinds.items()}).select(
        whole.alias("__key"), *[c for c in other.columns if c not in keys])
    left = df.withColumn("__key", whole)
    return left.join(unique_by(right, ["__key"]), "__key", "left").drop("__key")


def _hashed(kind: T.DataType) -> bool:
    """Can a maximum of this type be kept in a hash aggregation?"""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
                             T.TimestampNTZType))


def combine_sources(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of any number of frames that are unique per key.

    Stack the frames and aggregate by key: one exchange however many frames there
    are, and NULL keys fall together. A key that occurs twice in a frame is an error.
    Apart from the keys, every column belongs to one frame. Only numbers and dates are
    aggregated, by hash; texts are joined to the result from the frame that has them. The
    key is one struct, so those joins use the partitioning of the aggregation, and
    no column but the key is shuffled twice.
    """
    values = [c for frame in frames for c in frame.columns if c not in keys]
    shared = sorted({c for c in values if values.count(c) > 1})
    if shared:
        raise ValueError(f"columns of more than one source: {shared}")
    texts = {
        n: [f.name for f in frame.schema if f.name not in keys and not _hashed(f.dataType)]
        for n, frame in enumerate(frames)
    }
    stacked = None
    for number, frame in enumerate(frames):
        part = frame.drop(*texts[number]).withColumn("__source", F.lit(number))
        stacked = part if stacked is None else stacked.unionByName(part, True)
    once = " AND ".join(f"count_if(__source = {n}) < 2" for n in range(len(frames)))
    kinds = {k: stacked.schema[k].dataType for k in keys}
    key = F.struct(*[F.col(k).cast(kind).alias(f"k{i}")
                     for i, (k, kind) in enumerate(kinds.items())]).alias("__key")
    combined = (
        stacked.select(key, *[c for c in stacked.columns if c not in keys]).groupBy("__key")
        .agg(
            F.expr(f"assert_true({once}, 'a key occurs twice in one source')").alias("__once"),
            *[F.max(c).alias(c) for c in stacked.columns if c not in [*keys, "__source"]],
        )
        .filter(F.col("__once").isNull())
    )
    for number, columns in texts.items():
        if columns:
            combined = combined.join(frames[number].select(key, *columns), "__key", "left")
    return combined.select(
        *[F.col(f"__key.k{i}").alias(k) for i, k in enumerate(keys)], *values)


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame beside every row.

    A scalar subquery: evaluated once, no join, and more than one row is an error.
    """
    scalar = one_row.select(F.struct(*one_row.columns).alias("v")).scalar()
    return df.withColumns({c: scalar.getField(c) for c in one_row.columns})


def attach_context(
    df: DataFrame, context: DataFrame, period: str, keep_unmatched: bool = False
) -> DataFrame:
    """Put the period's overall value beside each row of that period.

    A period with two overall rows is an error. ``keep_unmatched`` adds the context rows
    whose period no row has: the rows of a full outer join, but the large side takes
    part in a left join only, which stays splittable.
    """
    values = [c for c in context.columns if c != period]
    context = context.groupBy(period).agg(*[single_value(c).alias(c) for c in values])
    out = left_join(df, context, [period]).select(*df.columns, *values)
    if not keep_unmatched:
        return out
    seen = df.select(F.col(period).alias("__seen")).distinct()
    unmatched = context.join(seen, F.col(period).eqNullSafe(F.col("__seen")), "left_anti")
    return out.unionByName(unmatched, allowMissingColumns=True)


def left_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which NULL keys match NULL keys.

    Also the form to use when ``other`` was aggregated by the same keys: a plain
    equality would reuse that partitioning and leave adaptive execution without a
    shuffle of its own to split a hot key in.
    """
    right = other.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(right, condition, "left").drop(*[f"__k_{k}" for k in keys])


def attach_group_values(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Group aggregates written to every member row.

    Aggregate first, then join back: a window would pull each whole group into one
    task, while here a hot group is pre-aggregated and its join partition split.
    """
    return left_join(df, df.groupBy(*keys).agg(*aggregates), keys)
