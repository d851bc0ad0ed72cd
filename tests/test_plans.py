"""What Spark makes of the frames: pruning, push-down, and no Python work on rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import plan
from ombuds.plans import analytics, marts, staging
from ombuds.schemas import RAW_TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def stored(spark, folder):
    """Empty RAW tables as files."""
    frames = {}
    for name, table in RAW_TABLES.items():
        spark.createDataFrame([], table.schema).write.parquet(f"{folder}/{name}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
    return {view: build(frames[name]) for name, (view, build) in staging.STAGING.items()}


def channels(stored):
    return {name: stored[name] for name in ("stg_call_logs", "stg_web_complaints", "stg_social_media")}


def test_high_water_mark_reaches_every_scan(stored):
    text = plan(marts.fct_unified_complaints(**channels(stored), since=dt.datetime(2025, 1, 1)))
    assert text.count("GreaterThan(_ingestion_time") == 3


def test_filter_on_a_channel_reads_only_that_channel(stored):
    fact = marts.fct_unified_complaints(**channels(stored))
    assert plan(fact.where(F.col("channel") == "Web Form")).count("FileScan") == 1


def test_reports_read_only_their_columns(stored):
    text = plan(analytics.failure_rate_by_category(marts.fct_calls(stored["stg_call_logs"])))
    assert "ReadSchema: struct<call_id:string,complaint_catego_ry:string,resolutionstatus:string>" in text


def test_reports_aggregate_before_the_shuffle(stored):
    text = plan(analytics.handling_time_by_category(marts.fct_calls(stored["stg_call_logs"])))
    exchange = text.index("Exchange hashpartitioning(complaint_category")
    assert "partial_avg" in text[exchange:]


def test_channel_hopping_merges_equal_times_before_the_shuffle(stored):
    text = plan(analytics.channel_hopping(marts.fct_unified_complaints(**channels(stored))))
    merged = text.index("functions=[partial_min(CASE WHEN (channel")
    assert "Window" in text[:merged] and "Window" not in text[merged:].split("FileScan")[0]


@pytest.mark.parametrize(
    "name", ["fct_unified_complaints", "dedup_latest", "merge_calls_partial", "dq_marts", "channel_hopping"]
)
def test_no_python_on_rows(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert not any(word in text for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"))
