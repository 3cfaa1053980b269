"""A reproducible shuffle into shards by a Feistel permutation of row numbers.

Only DataFrame functions. Rows are numbered in the order of a digest of their document, so
the numbers depend on the rows alone, not on files, partitions or cluster. A keyed
permutation of the numbers gives every row a place; place modulo shards is the shard, the
quotient the slot. Both ways can be worked out for a single row, without the others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geopanel.llm.common import pick, shared_folder, shared_table

ROUNDS = 8
#: Hex digits of the digest that name a bucket of rows: 4,096 buckets at every size.
BUCKET = 3
#: Rows with one digest beyond which they are numbered side by side.
TOGETHER = 1 << 16
#: Rows in one file of a written shard.
FILE_ROWS = 1 << 20


def halves(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n and as few places beyond n as two near-equal numbers allow."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _quotient(x: Column, by: int) -> Column:
    return ((x - x % by) / by).cast("bigint")


def _key(seed: int, turn: int, half: Column, size: int) -> Column:
    """The round function: 60 bits of a digest, modulo the size of the other half."""
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{turn}"), half.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % size


def _turns(x: Column, n: int, seed: int, back: bool) -> Column:
    """One pass of the network over the numbers below a * b, or its inverse."""
    a, b = halves(n)
    pair = F.struct((x % a).alias("l"), _quotient(x, a).alias("r"))

    # One lambda per round, so that each round reads the halves before it once.
    def step(turn: int):
        def run(p: Column) -> Column:
            left, right = p["l"], p["r"]
            if turn % 2 == 0:
                key = _key(seed, turn, right, a)
                return F.struct(F.pmod(left - key if back else left + key, F.lit(a))
                                .cast("bigint").alias("l"), right.alias("r"))
            key = _key(seed, turn, left, b)
            return F.struct(left.alias("l"), F.pmod(right - key if back else right + key, F.lit(b))
                            .cast("bigint").alias("r"))
        return run

    state = F.array(pair)
    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        state = F.transform(state, step(turn))
    end = state[0]
    return end["l"] + end["r"] * a


def walk_length(spark: SparkSession, n: int, seed: int, back: bool = False) -> int:
    """How often the network must be applied at most until every number below n is below n.

    Only numbers that some number below n is taken to are followed; they are among the a * b - n
    numbers from n on, about the root of n at most. Such a walk can't close on itself outside,
    so it ends.
    """
    a, b = halves(n)
    if a * b <= n:
        return 1
    outside = spark.range(n, a * b).withColumn("from", _turns(F.col("id"), n, seed, not back))
    now = shared_table(outside.filter(F.col("from") < n).select("id"), "walk")
    steps = 1
    while not now.isEmpty():
        steps += 1
        now = shared_table(now.select(_turns(F.col("id"), n, seed, back).alias("id"))
                           .filter(F.col("id") >= n), "walk")
    return steps


def permuted(x: Column, n: int, seed: int, steps: int, back: bool = False) -> Column:
    """The place of number ``x`` (or the number at a place) among n, by cycle walking."""
    once = _turns(x, n, seed, back)
    if steps == 1:
        return once
    return F.aggregate(
        F.sequence(F.lit(2), F.lit(steps)), once,
        lambda at, _: F.when(at < n, at).otherwise(_turns(at, n, seed, back)))


def numbered(rows: DataFrame, digest: str) -> DataFrame:
    """``rows`` with ``number``: 0, 1, ... in the order of the hex column ``digest``.

    Rows with the same digest are taken as equal, any order among them will do. They may be
    a third of all rows: beyond ``TOGETHER`` they are split by physical row and numbered
    side by side. Otherwise a bucket of digests is numbered by one task; no task sorts more.
    """
    slim = shared_table(rows.withColumn("__row", F.monotonically_increasing_id()), "to-number")
    copies = slim.groupBy(digest).agg(F.count(F.lit(1)).alias("n"))
    hot = shared_table(copies.filter(F.col("n") > TOGETHER).select(
        F.col(digest).alias("__hot"), (F.col("n") / TOGETHER).cast("bigint").alias("__parts")),
        "hot-digests")
    split = slim.join(hot, slim[digest] == F.col("__hot"), "left").drop("__hot").withColumns({
        "__bucket": F.substring(digest, 1, BUCKET),
        # What sorts before a hot digest, that digest in parts, what sorts behind it.
        "__part": F.pmod(F.xxhash64("__row"), F.col("__parts") + 1),
    })
    marks = hot.select(F.substring("__hot", 1, BUCKET).alias("__bucket"), "__hot").groupBy(
        "__bucket").agg(F.sort_array(F.collect_list("__hot")).alias("__marks"))
    split = split.join(marks, "__bucket", "left").withColumn(
        "__cell", F.coalesce(F.size(F.filter("__marks", lambda m: m <= F.col(digest))), F.lit(0)))
    split = split.withColumn("__cell", F.when(F.col("__marks").isNull(), 0).otherwise(
        2 * F.col("__cell") - F.when(F.col("__parts").isNotNull(), 1).otherwise(0)))
    split = split.withColumn("__part", F.coalesce("__part", F.lit(0).cast("bigint"))).drop(
        "__marks", "__parts")
    place = ["__bucket", "__cell", "__part"]
    cells = split.groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    buckets = cells.groupBy("__bucket").agg(F.sum("n").alias("n"))
    # One row per bucket, 4,096 at most whatever the table, then one window per bucket.
    bases = buckets.select("__bucket", (F.sum("n").over(
        W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    inside = F.sum("n").over(W.partitionBy("__bucket").orderBy("__cell", "__part")
                             .rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    starts = shared_table(cells.withColumn("inside", inside).join(bases, "__bucket").select(
        *place, (F.col("base") + F.col("inside")).alias("__start")), "starts")
    nth = F.row_number().over(W.partitionBy(*place).orderBy(digest, "__row"))
    return (split.withColumn("__nth", nth).join(starts, place)
            .withColumn("number", F.col("__start") + F.col("__nth") - 1)
            .drop(*place, "__row", "__nth", "__start"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 42,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, the ``carry`` columns, number, law, shard, slot, grown_shard.

    The law is ``rows``: the shards' counts differ by one at most. Rows are numbered from 0
    in the order of a digest of doc_id and text, the permutation of the numbers takes number
    to place, shard is place modulo ``shards`` and slot the quotient, so slots of a shard
    have no gaps. ``size`` is the text's UTF-8 bytes plus one. The same rows give the same
    shards and slots however they are stored. grown_shard belongs to another law and is null.

    Null texts have size 1 and checksum 0 and a digest of their own, apart from empty texts;
    null doc_ids are a value. Repeated rows are rows of their own and stand in any order among
    themselves. Extra columns are ignored unless named in ``carry``; no rows give no rows.
    """
    rows = pick(docs, "doc_id", "text", *[c for c in carry if c != "text"])
    body = F.coalesce(F.col("text"), F.lit(""))
    # Two md5 of 128 bits each: what they take as equal is equal.
    digest = F.md5(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))).cast("binary"))
    slim = rows.select(
        "doc_id", (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), *carry, digest.alias("__digest"))
    return _placed(numbered(slim, "__digest").drop("__digest"), shards, seed)


def _placed(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    rows = shared_table(rows, "numbered")
    n = rows.count()
    steps = walk_length(rows.sparkSession, n, seed)
    return rows.withColumn("__place", permuted(F.col("number"), n, seed, steps)).select(
        *rows.columns, F.lit("rows").alias("law"),
        (F.col("__place") % shards).cast("int").alias("shard"),
        _quotient(F.col("__place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def row_at(shard: Column, slot: Column, n: int, shards: int, seed: int, steps: int) -> Column:
    """The number of the row in a slot, without looking at any row.

    ``steps`` is ``walk_length(spark, n, seed, back=True)``.
    """
    place = slot.cast("bigint") * shards + shard
    return permuted(place, n, seed, steps, back=True)


def write_shards(docs: DataFrame, shards: int = 16, seed: int = 42,
                 carry: tuple[str, ...] = ("text",), path: str | None = None) -> str:
    """Write the shards, one folder each, rows in the order of their slots; returns the path.

    A file has ``FILE_ROWS`` slots of its shard, so a shard of any size spreads over tasks.
    """
    path = path or shared_folder(docs.sparkSession, "shards")
    rows = shard_documents(docs, shards, seed, carry).withColumn(
        "part", _quotient(F.col("slot"), FILE_ROWS))
    rows.repartition("shard", "part").sortWithinPartitions("shard", "part", "slot").drop(
        "part").write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("shard").parquet(path)
    return path
