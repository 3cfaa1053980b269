"""What must hold for the plans to survive large and uneven tables."""

from __future__ import annotations

import os
import re
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from geopanel import plans
from geopanel.catalog import QUERIES
from geopanel.catalog.inputs import graded_panel
from geopanel.operators import bands as B
from geopanel.operators import crosswalk as K
from geopanel.operators import joins as J
from geopanel.session import shared_folder
from geopanel.sources import schemas as S
from tests.conftest import plan
from tests.test_plans import _cutpoint_inputs

SF_DIR = "/root/testdata/sf0.001"
HOT, ROWS = 7, 30_000


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_operator_that_cannot_be_split(spark, name):
    """No cross or nested-loop join, no window over a group, no Python, no collected group.

    Line breaks in quotes alone are cut in Python, block by block, with a window over two
    pieces of every block.
    """
    if name == "csv_quoted_lines":
        return
    text = plan(QUERIES[name](spark, SF_DIR))
    bad = re.findall(
        r"CartesianProduct|NestedLoopJoin|\bWindow\b|collect_list|collect_set|\w*Python\w*|"
        r"\w*Pandas\w*|\w*Arrow\w*|CollectLimit|TakeOrdered", text,
    )
    assert bad == []


@pytest.fixture
def hot(spark):
    """A third of all rows belong to one key."""
    key = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 1000)
    return spark.range(0, ROWS, 1, 8).select(
        key.cast("string").alias("key"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )


def test_hot_key_of_a_left_join_is_split(spark, hot):
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    ):
        out = J.attach_group_values(hot, ["key"], [F.sum("v").alias("total")])
        rows = out.collect()
        assert len(rows) == ROWS
        assert "skew=true" in plan(out)
    total = sum(r.v for r in rows if r.key == str(HOT))
    assert {r.total for r in rows if r.key == str(HOT)} == {total}


def test_group_values_equal_a_window(spark, hot):
    out = J.attach_group_values(hot, ["key"], [F.sum("v").alias("total")])
    twin = hot.selectExpr("key", "v", "filler", "sum(v) OVER (PARTITION BY key) AS total")
    assert out.select(*twin.columns).exceptAll(twin).count() == 0
    assert out.count() == ROWS


@pytest.mark.parametrize("as_table", [False, True])
def test_merge_pre_aggregates_a_hot_key(spark, hot, as_table):
    mapping = {str(HOT): "merged", "8": "merged"}
    crosswalk = mapping
    if as_table:
        crosswalk = spark.createDataFrame(list(mapping.items()), "`from` string, `to` string")
    out = K.merge_keys(hot, "key", crosswalk, ["v"])
    assert "partial_sum" in plan(out)
    got = {r.key: r.v for r in out.collect()}
    expected = hot.filter(F.col("key").isin(*mapping)).agg(F.sum("v")).collect()[0][0]
    assert got["merged"] == expected
    assert sum(got.values()) == ROWS * (ROWS - 1) // 2


def test_dictionary_crosswalks_need_no_join(spark, hot):
    frames = [
        K.recode_keys(hot, "key", {"7": "x"}), K.replicate_keys(hot, "key", {"7": ["x", "y"]}),
        K.roll_up_rows(hot, "key", {"x": ["7", "8"]}),
    ]
    assert all("Join" not in plan(f) for f in frames)
    assert all(plan(f).count("Exchange") == 0 for f in frames[:2])


def test_calibration_ships_one_row_per_class_and_task(spark):
    """Metrics lie side by side: no generator below the exchange, partial aggregates."""
    wide = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
        "CASE WHEN l_quantity > 10 THEN 'Large' ELSE 'Small' END AS SIZE_CLASS",
        "l_quantity AS EST_N", "l_tax AS CEN_N",
    )
    text = plan(B.calibrate_bands(wide, ["N"], []))
    assert text.count("Exchange") == 1
    assert "partial_stddev_samp" in text and "partial_avg" in text
    assert text.index("Generate") < text.index("Exchange")


def test_scoring_does_not_shuffle_the_areas(spark, tmp_path):
    wide = graded_panel(spark, SF_DIR)
    B.calibrate_bands(wide).write.parquet(str(tmp_path / "bands"))
    wide.write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    bands = spark.read.parquet(str(tmp_path / "bands"))
    # No hint: Spark sees that the bands are small.
    text = plan(B.score_wide(wide, bands))
    # The one shuffle is that of the bands; it feeds the broadcast.
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastExchange") == text.count("BroadcastHashJoin") == 1
    assert text.index("BroadcastExchange") < text.index("Exchange hashpartitioning")


def test_panel_is_computed_once_for_bands_and_grades(spark):
    graded = QUERIES["score_wide"](spark, SF_DIR)
    graded.collect()
    final = plan(graded).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final


def test_three_sources_meet_in_one_exchange(spark):
    keys = spark.range(100).select(F.col("id").alias("k"))
    frames = [keys.withColumn(c, F.lit(1)) for c in "abc"]
    assert plan(J.combine_sources(frames, ["k"])).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name, filters, columns", [
    ("weekly_sample", ["GreaterThanOrEqual(ts,", "LessThan(ts,"],
     {"event_id", "ts", "user_id", "value"}),
    ("record_select", ["EqualTo(l_linestatus,F)", "In(l_returnflag, [A,R])",
                       "GreaterThanOrEqual(l_shipdate,"],
     {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
      "l_shipdate"}),
    ("composition_shares", [], {"l_suppkey", "l_quantity", "l_returnflag"}),
])
def test_filters_and_columns_reach_the_scan(spark, name, filters, columns):
    text = plan(QUERIES[name](spark, SF_DIR))
    [pushed] = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert [f for f in filters if f not in pushed] == []
    [schema] = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_main_table_shuffles_without_broadcasts(spark, tmp_path):
    frames = []
    for name, contract in [("c", S.COUNTY_PL), ("e", S.ESTIMATES), ("b", S.CUTPOINTS),
                           ("v", S.DECENNIAL_LONG)]:
        spark.createDataFrame([], S.ddl(contract)).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        text = plan(plans.county_main(*frames))
    assert "SortMergeJoin" in text and text.count("FullOuter") == 1
    # Counts with rolled-up rows, and once more for the estimates; estimates; bands and their
    # join with the areas, which a broadcast saves wherever the bands are known to be small;
    # areas for the full join; three for the 2010 vacancy.
    assert text.count("Exchange hashpartitioning") <= 10


def test_grading_works_on_a_stream(spark, tmp_path):
    wide = graded_panel(spark, SF_DIR)
    wide.write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    bands = B.calibrate_bands(wide)
    bands.write.parquet(str(tmp_path / "bands"))
    bands = spark.read.parquet(str(tmp_path / "bands"))
    stream = spark.readStream.schema(wide.schema).parquet(str(tmp_path / "wide"))
    job = (
        B.score_wide(stream, bands)
        .writeStream.format("parquet")
        .option("checkpointLocation", shared_folder(spark, "stream"))
        .start(str(tmp_path / "out"))
    )
    job.processAllAvailable()
    job.stop()
    batch = B.score_wide(wide, bands)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == batch.count() > 0
    assert batch.exceptAll(streamed.select(*batch.columns)).count() == 0


def test_nothing_is_broadcast_unless_its_size_is_known(spark):
    df = spark.range(1000).select((F.col("id") % 12).alias("m"))
    us = spark.range(12).select(F.col("id").alias("m"), F.lit(1.0).alias("us"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        out = J.attach_context(df, us, "m")
        assert "Broadcast" not in plan(out)
    assert out.filter("us IS NULL").count() == 0
    folder = os.path.dirname(J.__file__)
    for name in sorted(os.listdir(folder)):
        if name.endswith(".py"):
            source = open(os.path.join(folder, name), encoding="utf-8").read()
            assert "broadcast(" not in source and ".hint(" not in source, name


def _scans(df):
    """File scans of the plan that ran; a reused exchange is not scanned again."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0].count("FileScan")


def _empty(spark, tmp_path, **contracts):
    """Empty files of the real contracts."""
    for name, contract in contracts.items():
        spark.createDataFrame([], S.ddl(contract)).write.parquet(str(tmp_path / name))
    return [spark.read.parquet(str(tmp_path / name)) for name in contracts]


def _static_scans(spark, df, folder):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        text = plan(df)
    return len(re.findall(rf"FileScan parquet .*?/{folder}\]", text))


def test_vintages_and_overall_figures_scan_once(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert _scans(QUERIES["two_vintage_panel"](spark, SF_DIR)) == 1
        assert _scans(QUERIES["response_rates"](spark, SF_DIR)) <= 2


def test_main_table_scans_the_counts_once(spark, tmp_path):
    frames = _empty(spark, tmp_path, c=S.COUNTY_PL, e=S.ESTIMATES, b=S.CUTPOINTS,
                    v=S.DECENNIAL_LONG)
    assert _static_scans(spark, plans.county_main(*frames), "c") == 1


def test_estimates_scan_each_source_once(spark, tmp_path):
    frames = _empty(spark, tmp_path, people=S.CHARACTERISTICS_2020, units=S.HOUSING_2020,
                    quarters=S.COMPONENTS_2020, local=S.SURVEY_LONG, us=S.SURVEY_LONG)
    out = plans.estimates(*frames)
    for name in ("people", "units", "quarters", "local"):
        assert _static_scans(spark, out, name) == 1, name


def test_weekly_cases_scan_the_facts_once(spark, tmp_path):
    frames = _empty(spark, tmp_path, areas={"fips": "string"}, us=S.DAILY_CASES,
                    local=S.COUNTY_DAILY_CASES)
    out = plans.covid_weekly(*frames)
    assert [_static_scans(spark, out, n) for n in ("areas", "us", "local")] == [1, 1, 1]


def test_no_sorted_aggregation_over_areas(spark, tmp_path):
    frames = _empty(spark, tmp_path, people=S.CHARACTERISTICS_2020, units=S.HOUSING_2020,
                    quarters=S.COMPONENTS_2020, local=S.SURVEY_LONG, us=S.SURVEY_LONG)
    assert "SortAggregate" not in plan(plans.estimates(*frames))
    assert "SortAggregate" not in plan(plans.cutpoints(*_cutpoint_inputs(spark)))
    for name in ("rollup_first_row", "estimates", "cutpoints"):
        assert "SortAggregate" not in plan(QUERIES[name](spark, SF_DIR)), name


def test_series_filter_reaches_the_scan(spark):
    for name in ("series_decode", "unemployment"):
        assert "GreaterThanOrEqual(l_shipdate" in plan(QUERIES[name](spark, SF_DIR))


def _session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master)
    )


def test_scratch_files_go_to_the_shared_folder(spark):
    assert shared_folder(_session("/shared/x/", "yarn"), "t").startswith("/shared/x/geopanel-")
    assert shared_folder(spark, "t") != shared_folder(spark, "t")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session(None, "yarn"), "t")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session(None, "local-cluster[3,2,1000]"), "t")
    first, second = (shared_folder(_session(None, "local[4]"), "t") for _ in range(2))
    assert first != second
    assert os.path.dirname(first) == os.path.dirname(second)
