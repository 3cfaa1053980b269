"""Long tables of coded figures: ``(GEOID, NAME, variable, value)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.functions import alias_code
from geopanel.sources.delimited import read_csv
from geopanel.sources.schemas import DECENNIAL_LONG, SURVEY_LONG


def select_codes(
    df: DataFrame, codes: Sequence[str] | Mapping[str, str], variable: str = "variable"
) -> DataFrame:
    """Rows of the listed codes; a mapping also renames them (code -> name).

    The code list becomes an ``IN`` filter that reaches the scan.
    """
    kept = df.filter(F.col(variable).isin(list(codes)))
    if isinstance(codes, Mapping):
        kept = kept.withColumn(variable, alias_code(variable, codes))
    return kept


def _read(spark: SparkSession, path: str, contract, **options) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(*contract)
    return read_csv(spark, path, contract, **options)


def read_decennial(
    spark: SparkSession, path: str, codes: Sequence[str] | Mapping[str, str], **options
) -> DataFrame:
    """Counts of the listed codes from a landed snapshot (CSV or Parquet)."""
    return select_codes(_read(spark, path, DECENNIAL_LONG, **options), codes)


def read_survey(
    spark: SparkSession, path: str, codes: Sequence[str] | Mapping[str, str], **options
) -> DataFrame:
    """Survey estimates with margin of error of the listed codes."""
    return select_codes(_read(spark, path, SURVEY_LONG, **options), codes)
