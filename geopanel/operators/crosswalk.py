"""Area-code changes: merged, split and rolled-up codes.

A crosswalk is a small dictionary (it becomes a literal, so no join is planned) or a
DataFrame of (from, to) pairs of any size (it becomes a join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopanel.functions import alias_code, numeric_columns, strict_mean, strict_sum
from geopanel.operators.joins import unique_by
from geopanel.session import shared_folder

Crosswalk = Mapping[str, str] | DataFrame
Members = Mapping[str, Sequence[str]] | DataFrame


def _one_to_many(mapping: Mapping[str, Sequence[str]]) -> Column:
    pairs: list[Column] = []
    for source, targets in mapping.items():
        pairs += [F.lit(source), F.array(*[F.lit(t) for t in targets])]
    return F.create_map(*pairs)


def close_pairs(pairs: DataFrame) -> DataFrame:
    """All (from, to) that any number of steps of ``pairs`` leads along.

    Paths double in length with every round, so chains of n steps take about log n rounds;
    each is written to the shared folder, which ends the lineage. Pairs with a missing side
    and pairs of a code with itself lead nowhere; a code that leads back to itself over others
    is an error.
    """
    spark = pairs.sparkSession

    def landed(df: DataFrame) -> DataFrame:
        path = shared_folder(spark, "crosswalk-closure")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    found = landed(pairs.select("from", "to").filter(F.col("from") != F.col("to")).distinct())
    size = found.count()
    while True:
        onward = found.select(F.col("from").alias("to"), F.col("to").alias("beyond"))
        longer = found.join(onward, "to").select("from", F.col("beyond").alias("to"))
        found = landed(found.union(longer).distinct())
        circle = found.filter(F.col("from") == F.col("to")).first()
        if circle is not None:
            raise ValueError(f"the crosswalk leads from {circle['from']} back to it")
        before, size = size, found.count()
        if size == before:
            return found


def last_codes(crosswalk: Crosswalk) -> Crosswalk:
    """A crosswalk from every code to the one at the end of its chain of successors.

    Codes change more than once over vintages: a -> b and b -> c give a -> c and b -> c. A
    circle is an error, and so is a code with two successors.
    """
    if isinstance(crosswalk, DataFrame):
        steps = _single(crosswalk)
        closed = close_pairs(steps)
        first = steps.filter(F.col("from") != F.col("to")).select(F.col("from").alias("to"))
        return closed.join(first, "to", "left_anti").select("from", "to")
    last = {}
    for code in crosswalk:
        seen, at = [code], crosswalk[code]
        while at in crosswalk and crosswalk[at] != at:
            if at in seen:
                raise ValueError(f"the crosswalk leads from {at} back to it")
            seen.append(at)
            at = crosswalk[at]
        last[code] = at
    return last


def _single(crosswalk: DataFrame) -> DataFrame:
    """(from, to), or an error if a code has two successors, also the same one twice."""
    return unique_by(crosswalk.select("from", "to"), ["from"])


def _distinct(crosswalk: DataFrame) -> DataFrame:
    """(from, to), or an error if a pair occurs twice."""
    return unique_by(crosswalk.select("from", "to"), ["from", "to"])


def recode_keys(
    df: DataFrame, key: str, crosswalk: Crosswalk, chains: bool = False,
) -> DataFrame:
    """Replace codes that have a successor; all other codes stay.

    A code with two successors in a table is an error: it would double its figures.
    ``chains`` follows successors of successors to the last one.
    """
    if chains:
        crosswalk = last_codes(crosswalk)
    if isinstance(crosswalk, DataFrame):
        pairs = _single(crosswalk).select(F.col("from").alias("__from"), F.col("to").alias("__to"))
        return (
            df.join(pairs, F.col(key) == F.col("__from"), "left")
            .withColumn(key, F.coalesce("__to", key))
            .select(*df.columns)
        )
    return df.withColumn(key, F.coalesce(alias_code(key, crosswalk), F.col(key)))


def merge_keys(
    df: DataFrame, key: str, crosswalk: Crosswalk, sums: Sequence[str] | None = None,
    by: Sequence[str] = (), chains: bool = False,
) -> DataFrame:
    """Recode N codes to 1 and add their figures up again; see ``recode_keys``."""
    columns = list(sums) if sums is not None else numeric_columns(df, [key, *by])
    return (
        recode_keys(df, key, crosswalk, chains)
        .groupBy(key, *by)
        .agg(*[strict_sum(c).alias(c) for c in columns])
    )


def replicate_keys(df: DataFrame, key: str, crosswalk: Members) -> DataFrame:
    """Copy a code's rows to the codes it was split into; the old code stays.

    A single pass over the input: one generator with a dictionary, one left join with a
    table, to which every split code is added as a target of its own. A pair that occurs twice
    in a table is an error: it would double the new code's figures.
    """
    if isinstance(crosswalk, DataFrame):
        pairs = _distinct(crosswalk).select(F.col("from").alias("__from"), F.col("to").alias("__to"))
        pairs = pairs.union(pairs.select("__from", "__from").distinct())
        return (
            df.join(pairs, F.col(key) == F.col("__from"), "left")
            .withColumn(key, F.coalesce("__to", key))
            .select(*df.columns)
        )
    targets = F.coalesce(
        F.try_element_at(_one_to_many(crosswalk), F.col(key)), F.array().cast("array<string>")
    )
    keys = F.concat(F.array(F.col(key)), targets)
    return df.select(
        *[F.explode(keys).alias(key) if c == key else F.col(c) for c in df.columns]
    )


def roll_up_rows(
    df: DataFrame, key: str, members: Members, by: Sequence[str] = (),
    how: str = "sum", weight: str | None = None, columns: Sequence[str] | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Only the rows of the rolled-up codes: one per parent (and ``by`` group).

    ``how`` is "sum" or "mean" over the member rows; ``weight`` makes the mean a
    weighted one. A parent without member rows gives no row. ``extra`` are further
    aggregates (names, for instance).
    """
    figures = list(columns) if columns is not None else numeric_columns(df, [key, *by])
    if isinstance(members, DataFrame):
        pairs = _distinct(members).select(
            F.col("from").alias("__from"), F.col("to").alias("__parent"))
        rows = df.join(pairs, F.col(key) == F.col("__from"))
    else:
        parents: dict[str, list[str]] = {}
        for parent, codes in members.items():
            for code in codes:
                parents.setdefault(code, []).append(parent)
        rows = df.filter(F.col(key).isin(sorted(parents))).withColumn(
            "__parent", F.explode(F.element_at(_one_to_many(parents), F.col(key)))
        )
    if weight is not None:
        aggregates = [
            (strict_sum(F.col(c) * F.col(weight)) / F.nullif(strict_sum(weight), F.lit(0)))
            .alias(c)
            for c in figures if c != weight
        ]
        if weight in figures:
            aggregates.append(strict_sum(weight).alias(weight))
    else:
        combine = {"sum": strict_sum, "mean": strict_mean}[how]
        aggregates = [combine(c).alias(c) for c in figures]
    return (
        rows.groupBy("__parent", *by)
        .agg(*aggregates, *extra)
        .withColumnRenamed("__parent", key)
    )


def all_members(members: Members) -> Members:
    """Parents with the members of their members, down a tree of any depth.

    A circle is an error, and so is a table's pair that occurs twice.
    """
    if isinstance(members, DataFrame):
        return close_pairs(_distinct(members))

    def below(parent: str, above: tuple[str, ...]) -> list[str]:
        if parent in above:
            raise ValueError(f"the crosswalk leads from {parent} back to it")
        found = []
        for code in members.get(parent, ()):
            found += [code, *below(code, (*above, parent))]
        return list(dict.fromkeys(found))

    return {parent: below(parent, ()) for parent in members}


def _beside_parents(df: DataFrame, key: str, members: Members) -> DataFrame:
    """Every row under its own code, and again under each code it rolls up to (__rolled)."""
    if isinstance(members, DataFrame):
        pairs = _distinct(members).select(
            F.col("from").alias("__from"), F.col("to").alias("__to"), F.lit(True).alias("__up"))
        pairs = pairs.union(pairs.select("__from", "__from", F.lit(False)).distinct())
        return df.join(pairs, F.col(key) == F.col("__from"), "left").withColumns({
            key: F.coalesce("__to", key), "__rolled": F.coalesce("__up", F.lit(False))
        })
    parents: dict[str, list[str]] = {}
    for parent, codes in members.items():
        for code in codes:
            parents.setdefault(code, []).append(parent)
    targets = F.coalesce(
        F.try_element_at(_one_to_many(parents), F.col(key)), F.array().cast("array<string>")
    )
    places = F.concat(
        F.array(F.struct(F.col(key).alias("code"), F.lit(False).alias("rolled"))),
        F.transform(targets, lambda t: F.struct(t.alias("code"), F.lit(True).alias("rolled"))),
    )
    return df.withColumn("__place", F.explode(places)).withColumns({
        key: F.col("__place.code"), "__rolled": F.col("__place.rolled")
    })


def roll_up(
    df: DataFrame, key: str, members: Members, by: Sequence[str] = (),
    how: str = "sum", weight: str | None = None, columns: Sequence[str] | None = None,
    extra: Mapping[str, Column] | None = None,
    labels: Mapping[str, Mapping[str, str]] | None = None,
    mark: str | None = None, nested: bool = False,
) -> DataFrame:
    """All rows, plus one row per rolled-up code; the member rows stay.

    One pass and one aggregation: a row stands under its own code and under its parents.
    ``key`` and ``by`` must be unique together, a repeated row is an error. ``columns``
    (all numeric ones by default) are rolled up as in ``roll_up_rows``, further numeric ones
    are NULL for the new rows, and the ``extra`` aggregates, by name, run over member rows
    and own rows alike. Text columns are named in ``labels``, with the texts of the new rows by
    code; a column that is neither numeric nor named there or in ``extra`` is an error.
    ``mark`` names a column that tells the new rows. ``nested`` takes ``members`` as a tree:
    a parent adds up the members of its members too, each once.
    """
    labels = labels or {}
    if nested:
        members = all_members(members)
    numbers = numeric_columns(df, [key, *by])
    figures = list(columns) if columns is not None else numbers
    rolled = F.col("__rolled")
    if weight is not None:
        combined = {
            c: strict_sum(F.col(c) * F.col(weight)) / F.nullif(strict_sum(weight), F.lit(0))
            for c in figures if c != weight
        }
        if weight in figures:
            combined[weight] = strict_sum(weight)
    else:
        combine = {"sum": strict_sum, "mean": strict_mean}[how]
        combined = {c: combine(c) for c in figures}
    extra = extra or {}
    known = {key, *by, *labels, *extra, *figures, *numbers}
    lost = [c for c in df.columns if c not in known]
    if lost:
        raise ValueError(f"neither figures nor in labels or extra: {lost}")
    aggregates = [
        (F.when(rolled, combined[c]) if c in combined else F.when(rolled, None))
        .otherwise(F.max(c)).alias(c)
        for c in dict.fromkeys([*figures, *numbers]) if c not in extra
    ]
    texts = {
        c: F.when(rolled, alias_code(key, names) if names
                  else F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c, names in labels.items()
    }
    out = (
        _beside_parents(df, key, members).withColumns(texts)
        .groupBy(key, "__rolled", *by, *labels)
        .agg(
            F.expr("assert_true(__rolled OR count(1) < 2, 'a key occurs twice')").alias("__once"),
            *aggregates, *[c.alias(name) for name, c in extra.items()],
        )
        .filter(F.col("__once").isNull())
    )
    kept = [c for c in df.columns if c in out.columns]
    return out.select(*kept, *([rolled.alias(mark)] if mark else []))
