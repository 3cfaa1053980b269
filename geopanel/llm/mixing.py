"""Mixing sources to target weights by a hierarchical token budget.

Only DataFrame functions; documents are read for their word counts once and are never
shuffled: what is shuffled are word counts and sums per leaf of the tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geopanel.llm.common import hold, pick, shared_table

#: Hex digits of the order key by which a step of the prefix sums divides a bucket, and steps.
DIGITS, STEPS = 2, 3
TOKENS = "decimal(20,0)"
WEIGHT = "decimal(17,0)"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def order_key(doc_id: Column, epoch: Column, seed: int) -> Column:
    """Place of a document in the order of an epoch: a seeded digest."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit("-"))))


def _budgets(leaves: DataFrame, path: Sequence[str], weights: Mapping[str, str],
             budget_share: float, max_epochs: int) -> DataFrame:
    """Leaves with their allocation of tokens (``alloc``).

    Bottom-up every node gets a capacity: what its leaves hold in all their epochs, nothing
    for nodes of weight 0. Top-down the budget of a node is spread over its children by
    weight; children that can't take their share are filled and the shortage goes to their
    siblings. Only what a whole subtree can't take has gone to its ancestors' siblings, by
    the capacity of the subtree.
    """
    levels = []
    below = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for k in range(len(path), 0, -1):
        node = below.groupBy(*path[:k]).agg(F.sum("cap").cast(TOKENS).alias("cap"))
        weight = F.coalesce(F.expr(weights.get(path[k - 1], "1")).cast(WEIGHT),
                            F.lit(0).cast(WEIGHT))
        below = shared_table(
            node.withColumn("w", weight)
            .withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(0).cast(TOKENS)),
            "capacities")
        levels.append(below)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    parent = None
    for k, nodes in enumerate(reversed(levels), 1):
        if parent is None:
            rows = nodes.withColumn("b", F.least(
                F.lit(int(total * budget_share)).cast(TOKENS),
                F.sum("cap").over(W.partitionBy(F.lit(0))).cast(TOKENS)))
            siblings = [F.lit(0)]
        else:
            rows = nodes.join(parent.withColumnRenamed("alloc", "b"), list(path[:k - 1]))
            siblings = [F.col(c) for c in path[:k - 1]]
        # Filled children come first in the order of capacity over weight.
        ratio = F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double"))
        by = W.partitionBy(*siblings).orderBy(ratio.asc_nulls_first(), path[k - 1])
        before = F.coalesce(F.sum("cap").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        since = F.sum("w").over(by.rowsBetween(0, W.unboundedFollowing))
        rows = rows.withColumn("before", before.cast(TOKENS)).withColumn("since", since.cast(WEIGHT))
        rows = rows.withColumn("full", F.expr("(b - before) * w >= cap * since"))
        group = W.partitionBy(*siblings)
        rows = rows.withColumn("filled", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap")))
                                                    .over(group), F.lit(0)).cast(TOKENS))
        rows = rows.withColumn("rest", F.sum(F.when(~F.col("full"), F.col("w"))).over(group)
                               .cast(WEIGHT))
        parent = shared_table(rows.select(*path[:k], F.when(F.col("full"), F.col("cap")).otherwise(
            F.expr("((b - filled) * w) div rest")).cast(TOKENS).alias("alloc")), "budgets")
    return leaves.join(parent, list(path)).withColumn("alloc", F.col("alloc").cast("bigint"))


def _cuts(slim: DataFrame, plan: DataFrame, path: Sequence[str], seed: int) -> DataFrame:
    """Per leaf the order key up to which documents of its last epoch are taken.

    A prefix sum in steps, so that no leaf has to be sorted in one task: sums over 16^DIGITS
    buckets of keys find the bucket in which the budget ends, the same is done within it,
    and after STEPS steps its documents are added up one by one.
    """
    open_ = plan.filter("left > 0")
    keyed = slim.join(open_, list(path)).select(
        *path, "n_tokens", order_key(F.col("doc_id"), F.col("epochs"), seed).alias("k"))
    ends = open_.select(*path, "left", F.lit("").alias("bucket"), F.lit(0).cast("bigint")
                        .alias("base"))
    for step in range(STEPS + 1):
        inside = keyed.withColumn("bucket", F.substring("k", 1, DIGITS * step)).join(
            ends, [*path, "bucket"])
        if step == STEPS:
            break
        sums = inside.groupBy(*path, F.substring("k", 1, DIGITS * (step + 1)).alias("bucket"),
                              "left", "base").agg(F.sum("n_tokens").alias("n"))
        run = sums.withColumn("upto", F.col("base") + F.sum("n").over(
            W.partitionBy(*path).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)))
        over = run.filter("upto > left")
        first = over.groupBy(*path).agg(F.min("upto").alias("upto"))
        ends = shared_table(over.join(first, [*path, "upto"]).select(
            *path, "left", "bucket", (F.col("upto") - F.col("n")).alias("base")), "cut-buckets")
    placed = inside.withColumn("upto", F.col("base") + F.sum("n_tokens").over(
        W.partitionBy(*path).orderBy("k").rangeBetween(W.unboundedPreceding, W.currentRow)))
    last = placed.filter("upto <= left").groupBy(*path).agg(F.max("k").alias("k"))
    return ends.join(last, list(path), "left").select(
        *path, F.coalesce("k", "bucket").alias("cut"))


def _slim(docs: DataFrame, levels: Mapping[str, str], more: Sequence[str] = ()) -> DataFrame:
    """doc_id, path and ``more``, with the word count; missing names are empty."""
    return docs.select(
        "doc_id", *[F.coalesce(F.expr(c).cast("string"), F.lit("")).alias(n)
                    for n, c in levels.items()],
        *more, word_count(F.col("text")).alias("n_tokens"))


def mix_plan(docs: DataFrame, levels: Mapping[str, str], weights: Mapping[str, str],
             budget_share: float, max_epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(documents without text, leaves with tokens, alloc, epochs, left and cut)."""
    path = list(levels)
    slim = shared_table(_slim(docs, levels).filter("n_tokens > 0"), "word-counts")
    leaves = shared_table(
        slim.groupBy(*path).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = shared_table(
        _budgets(leaves, path, weights, budget_share, max_epochs)
        .withColumn("epochs", F.expr("alloc div tokens"))
        .withColumn("left", F.expr("alloc % tokens")), "plan")
    cuts = _cuts(slim, plan, path, seed)
    return slim, shared_table(plan.join(cuts, path, "left"), "plan-with-cuts")


def _copies(seed: int) -> Column:
    """How often a document is taken: its leaf's whole epochs, and once more up to the cut."""
    last = order_key(F.col("doc_id"), F.col("epochs"), seed) <= F.col("cut")
    return (F.col("epochs") + F.when(last, 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, levels: Mapping[str, str], weights: Mapping[str, str], *,
        budget_share: float = 1.0, max_epochs: int = 4, seed: int = 42,
        uses: Sequence[str] = ("lang", "source")) -> DataFrame:
    """doc_id, the path, n_tokens and epoch: one row per document and epoch it is taken in.

    ``levels`` names the tree from the top (domain, language, source) by SQL expressions of
    the columns of ``docs`` named in ``uses``; ``weights`` has a whole-number weight per level as a SQL
    expression of the path, 1 by default, 0 or null takes nothing. The budget is a share of all tokens
    (words) of the table; no leaf is repeated more than ``max_epochs`` times. Each epoch of
    a leaf has its own seeded order; whole epochs are taken, then the longest prefix of the
    next that the budget allows. Shares are rounded down, so the budget is never exceeded.

    Null names are an empty name; texts without words (null too) are never taken; rows with
    the same doc_id, and all rows without one, stand side by side in the order and are taken
    or left together. Extra columns are ignored; an empty table gives an empty result.
    """
    path = list(levels)
    rows = pick(docs, "doc_id", "text", *uses)
    slim, plan = mix_plan(rows, levels, weights, budget_share, max_epochs, seed)
    taken = slim.join(plan.select(*path, "epochs", "cut"), path).withColumn(
        "copies", _copies(seed)).filter("copies > 0")
    return taken.select("doc_id", *path, "n_tokens", F.explode(
        F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))


def mix_documents(docs: DataFrame, levels: Mapping[str, str], weights: Mapping[str, str], *,
                  budget_share: float = 1.0, max_epochs: int = 1, seed: int = 42,
                  uses: Sequence[str] = ("lang", "source")) -> DataFrame:
    """The chosen rows of ``docs`` with all their columns, as often as they are taken."""
    path = list(levels)
    held, back = hold(docs, "doc_id", "text", *uses)
    _, plan = mix_plan(held, levels, weights, budget_share, max_epochs, seed)
    named = {f"__{n}": F.coalesce(F.expr(c).cast("string"), F.lit("")) for n, c in levels.items()}
    plan = plan.select(*[F.col(n).alias(f"__{n}") for n in path], "epochs", "cut")
    taken = (
        held.withColumns(named).filter(word_count(F.col("text")) > 0)
        .join(plan, list(named)).withColumn("__copies", _copies(seed)).filter("__copies > 0")
    )
    if max_epochs > 1:
        taken = taken.withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return back(taken)
