import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan, rows
from ombuds.operators.clustered import read_clustered, write_clustered
from ombuds.operators.tables import VersionedTable
from ombuds.plans import analytics, marts, staging
from ombuds.schemas import RAW_TABLES, UNIFIED

T = dt.datetime


def raw(spark, name, *records):
    schema = RAW_TABLES[name].schema
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schema)


def test_staging_has_the_declared_columns_and_types(spark):
    expected = {
        "customers": "customer_id customer_name gender date_of_birth:date signup_date:date email address",
        "agents": "agent_id agent_name experience state",
        "call_center_logs": "call_id source_row_id customer_id agent_id complaint_category resolution_status "
        "call_start_time:timestamp_ntz call_end_time:timestamp_ntz call_logs_generation_date:date",
        "web_complaints": "request_id source_row_id customer_id agent_id complaint_category resolution_status "
        "request_date:timestamp_ntz resolution_date:timestamp_ntz web_form_generation_date:date",
        "social_media": "complaint_id customer_id agent_id complaint_category media_channel resolution_status "
        "request_date:timestamp_ntz resolution_date:timestamp_ntz media_complaint_generation_date:date",
    }
    staged = staging.register_views({name: raw(spark, name) for name in expected})
    for name, columns in expected.items():
        pairs = [(*column.split(":"), "string")[:2] for column in columns.split()]
        view = staging.STAGING[name][0]
        assert staged[view].dtypes == [*pairs, ("_ingestion_time", "timestamp_ntz")]
        assert spark.table(view).columns == staged[view].columns


def test_customer_age_is_a_year_difference(spark):
    df = staging.stg_customers(raw(spark, "customers", {"customer_id": "1", "date_of_birth": "2000-12-31"}))
    assert marts.dim_customers(df, F.lit(dt.date(2001, 1, 1))).first().customer_age == 1
    today = marts.dim_customers(df).first().customer_age
    assert today == dt.datetime.now(dt.timezone.utc).year - 2000


def test_calendar(spark):
    days = marts.dim_date(spark)
    assert days.count() == 2192
    first, last = days.orderBy("date_day").first(), days.orderBy(F.desc("date_day")).first()
    assert tuple(first) == (dt.date(2024, 1, 1), 2024, 1, "Jan", 1, 1)
    assert tuple(last) == (dt.date(2029, 12, 31), 2029, 12, "Dec", 1, 4)


def test_calls_without_end_have_no_duration(spark):
    call = {"call_id": "1", "call_start_time": "2025-01-01 00:00:00", "call_end_time": "oops"}
    row = marts.fct_calls(staging.stg_call_logs(raw(spark, "call_center_logs", call))).first()
    assert row.call_end_time is None and row.call_duration_seconds is None


def three_channels(spark, day=T(2025, 1, 1), category="x"):
    shared = {"customer_id": "c", "complaint_catego_ry": category, "_ingestion_time": day}
    return {
        "stg_call_logs": staging.stg_call_logs(raw(spark, "call_center_logs", {"call_id": "1", **shared})),
        "stg_web_complaints": staging.stg_web_complaints(raw(spark, "web_complaints", {"request_id": "1", **shared})),
        "stg_social_media": staging.stg_social_media(raw(spark, "social_media", {"complaint_id": None, **shared})),
    }


def test_unified_keys_and_channels(spark):
    df = marts.fct_unified_complaints(**three_channels(spark))
    assert df.schema.names == UNIFIED.names
    key = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert {row.channel: row.complaint_pk for row in df.collect()} == {
        "Call Center": key("1-Call Center"),
        "Web Form": key("1-Web Form"),
        "Social Media": key("_dbt_utils_surrogate_key_null_-Social Media"),
    }


def test_high_water_mark_is_strict_by_default(spark):
    staged, day = three_channels(spark), T(2025, 1, 1)
    assert marts.fct_unified_complaints(**staged, since=day).isEmpty()
    assert marts.fct_unified_complaints(**staged, since=day, include_since=True).count() == 3


def test_incremental_fact(spark, folder):
    fact = VersionedTable(spark, f"{folder}/fact", UNIFIED, "complaint_pk", 2)
    assert marts.high_water_mark(fact.read()) is None
    marts.refresh_unified(fact, **three_channels(spark))
    assert fact.read().count() == 3
    marts.refresh_unified(fact, **three_channels(spark, category="late, same time"))
    assert rows(fact.read(), "complaint_category") == [("x",)] * 3
    marts.refresh_unified(fact, **three_channels(spark, T(2025, 1, 2), "new"))
    assert rows(fact.read(), "complaint_category") == [("new",)] * 3


def test_unassigned_agent(spark):
    agents = marts.dim_agents(staging.stg_agents(raw(spark, "agents", {"id": "7", "name": "x"})), unassigned=True)
    assert rows(agents, "agent_id", "agent_name") == [("-1", "Unassigned"), ("7", "x")]
    fact = marts.assign_agents(spark.createDataFrame([("7",), (None,)], "agent_id string"))
    assert rows(fact) == [("-1",), ("7",)]


# clustered layout


def test_clustered_layout_prunes_folders_and_rows(spark, folder):
    data = [(str(i), T(2025, 1, 1) + dt.timedelta(days=i)) for i in range(90)] + [("none", None)]
    write_clustered(spark.createDataFrame(data, "complaint_pk string, started_at timestamp_ntz"), folder)
    assert read_clustered(spark, folder).count() == 91
    some = read_clustered(spark, folder, dt.date(2025, 2, 10), dt.date(2025, 3, 1))
    assert some.count() == 20 and "started_month" not in some.columns
    text = plan(some)
    assert "PartitionFilters: [isnotnull(started_month" in text and "GreaterThanOrEqual(started_date" in text


def test_a_hot_day_is_cut_into_several_files(spark, folder):
    hot = spark.range(20000).selectExpr(
        "md5(cast(id as string)) complaint_pk", "timestamp_ntz'2025-01-05 10:00:00' started_at"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(hot, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(read_clustered(spark, folder).inputFiles()) == 4


# analyst queries


def test_failure_rate_is_ordered_as_text(spark):
    data = [("nine", "Backlog" if i < 9 else "Resolved") for i in range(100)]
    data += [("ten", "Backlog" if i < 1 else None) for i in range(10)] + [("half", "Backlog")] + [("half", "x")] * 199
    df = spark.createDataFrame([(str(i), *row) for i, row in enumerate(data)], "call_id string, complaint_category string, resolution_status string")
    found = [tuple(row) for row in analytics.failure_rate_by_category(df).collect()]
    assert [(row[0], row[4]) for row in found] == [("nine", "9%"), ("ten", "10%"), ("half", "1%")]
    assert found[1] == ("ten", 10, 1, 10, "10%")


def test_category_without_call_ids_has_no_rate(spark):
    df = spark.createDataFrame([(None, "x", "Backlog")], "call_id string, complaint_category string, resolution_status string")
    row = analytics.failure_rate_by_category(df).first()
    assert (row.total_calls, row.backlog_count, row.failure_rate) == (0, 1, None)


def test_handling_time(spark):
    data = [("1", "a", 90), ("2", "a", 120), ("3", "b", 600), ("4", "b", None)]
    df = spark.createDataFrame(data, "call_id string, complaint_category string, call_duration_seconds bigint")
    found = [tuple(row) for row in analytics.handling_time_by_category(df).collect()]
    assert found == [("b", 2, 10.0), ("a", 2, 1.8)]


def test_namesakes_merge_and_ties_are_ordered(spark):
    customers = spark.createDataFrame([("1", "Ann"), ("2", "Ann"), ("3", "Bob"), ("4", "Cy"), ("4", "Cy")], "customer_id string, customer_name string")
    data = [("1", "Web Form")] * 2 + [("2", "Call Center")] + [("3", "Web Form")] * 9
    data += [("4", "Web Form"), ("4", "Social Media"), ("9", "Web Form"), (None, "Web Form")]
    fact = spark.createDataFrame(data, "customer_id string, channel string")
    found = [tuple(row) for row in analytics.multi_channel_customers(fact, customers).collect()]
    assert found == [("Cy", 2, 4), ("Ann", 2, 3)]
    assert len(analytics.multi_channel_customers(fact, customers, top=1).collect()) == 1


def test_top_customers_need_no_full_sort(spark):
    customers = spark.createDataFrame([("1", "Ann")], "customer_id string, customer_name string")
    fact = spark.createDataFrame([("1", "Web Form")], "customer_id string, channel string")
    text = plan(analytics.multi_channel_customers(fact, customers))
    assert "TakeOrderedAndProject" in text
    assert "partial_count" in text[text.index("Join") :]


times = st.integers(0, 40).map(lambda step: T(2025, 1, 1) + dt.timedelta(seconds=step * 1337))
events = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["Call Center", "Web Form"]), times), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(events)
def test_channel_hopping_finds_the_first_call(spark, found):
    data = [(f"{i:02}", *event) for i, event in enumerate(found)]
    df = spark.createDataFrame(data, "complaint_pk string, customer_id string, channel string, started_at timestamp_ntz")
    expected = []
    for pk, customer, channel, start in data:
        calls = [(t, k) for k, c, ch, t in data if ch == "Call Center" and c == customer]
        calls = [call for call in calls if start <= call[0] <= start + dt.timedelta(hours=3)]
        if channel != "Call Center" and calls:
            expected.append((pk, *min(calls)[::-1]))
    got = analytics.channel_hopping(df, within_hours=3).select("complaint_pk", "call_pk", "called_at")
    assert rows(got) == expected


@pytest.mark.parametrize("missing", ["customer_id", "started_at"])
def test_channel_hopping_ignores_incomplete_rows(spark, missing):
    data = [("1", "a", "Web Form", T(2025, 1, 1)), ("2", "a", "Call Center", T(2025, 1, 1))]
    df = spark.createDataFrame(data, "complaint_pk string, customer_id string, channel string, started_at timestamp_ntz")
    assert analytics.channel_hopping(df).count() == 1
    gap = df.withColumn(missing, F.when(F.col("channel") == "Web Form", F.col(missing)))
    assert analytics.channel_hopping(gap).isEmpty()


def test_channel_hopping_shuffles_instants_once_a_level(spark, tmp_path):
    """Instants, their minutes and the complaints are shuffled once each, besides what is found."""
    start = T(2025, 1, 1)
    data = [
        (f"{i:04}", str(i % 7), ("Call Center", "Web Form", "Social Media")[i % 3], start + dt.timedelta(minutes=i * 7 % 4000))
        for i in range(600)
    ]
    schema = "complaint_pk string, customer_id string, channel string, started_at timestamp_ntz"
    spark.createDataFrame(data, schema).write.parquet(f"file://{tmp_path}/fact")
    got = analytics.channel_hopping(spark.read.parquet(f"file://{tmp_path}/fact"), within_hours=2)
    got = got.select("complaint_pk", "call_pk", "called_at")
    found = sorted(tuple(row) for row in got.collect())
    expected = []
    for pk, customer, channel, at in data:
        calls = [(t, k) for k, c, ch, t in data if ch == "Call Center" and c == customer and at <= t <= at + dt.timedelta(hours=2)]
        if channel != "Call Center" and calls:
            expected.append((pk, *min(calls)[::-1]))
    assert found == expected
    text = plan(got).split("Initial Plan")[0]
    assert "ReusedExchange" in text
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) <= 6
