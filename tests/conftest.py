from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from geopanel.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4", "spark.sql.maxMetadataStringLength": "10000",
        "spark.sql.debug.maxToStringFields": "1000",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of one expression over one row of named values."""

    def evaluate(expression, **values):
        row = spark.range(1).select(*[
            (v if hasattr(v, "alias") else F.lit(v)).alias(k) for k, v in values.items()
        ])
        return row.select(expression.alias("out")).collect()[0]["out"]

    return evaluate


@pytest.fixture
def rows():
    """Sorted tuples of a frame."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()),
                      key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
