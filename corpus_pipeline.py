"""A corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; what it
returns is written as Parquet and read again for the next one. All stages but the last
return the columns of ``documents``. Extra columns are dropped at the start of a stage;
what nulls, empty texts, ties and repeated rows mean is said by each stage's operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.llm.common import pick, shared_table, table
from geopanel.llm.linededup import drop_repeated_lines
from geopanel.llm.mixing import mix_documents
from geopanel.llm.packing import packed_digest
from geopanel.llm.quality import keep_good
from geopanel.llm.queries import MIX_LEVELS, MIX_WEIGHTS, TOKENIZER
from geopanel.llm.simhash import keep_one

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, judged with the verdict on their source."""
    return keep_good(pick(docs, *COLUMNS), host="source", limit=0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of 30 words or more that an earlier document has are cut out of later ones.

    A document that had text and is left without any goes.
    """
    short = drop_repeated_lines(pick(docs, *COLUMNS), min_words=30, over_blank=True)
    return short.filter("n_removed = 0 OR text != ''").withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint"))
        .otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the least doc_id."""
    return keep_one(pick(docs, *COLUMNS), words=3, threshold=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights within 95 % of all words, no document twice."""
    return mix_documents(pick(docs, *COLUMNS), MIX_LEVELS, MIX_WEIGHTS, budget_share=0.95,
                         max_epochs=1, seed=42)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents and their places in sequences of 2048 tokens."""
    return packed_digest(pick(docs, *COLUMNS), TOKENIZER, capacity=2048, end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Alignment, fingerprints and tokens can't be written in SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
