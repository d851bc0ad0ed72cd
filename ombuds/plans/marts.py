"""Dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ombuds.functions.dates import day_of_week, hours_between, month_name, seconds_between, years_between
from ombuds.functions.keys import surrogate_key
from ombuds.operators.quality import CHANNELS
from ombuds.operators.tables import VersionedTable
from ombuds.schemas import AUDIT

# Calendar range (end exclusive) and the agent id of unassigned complaints.
FIRST_DAY, END_DAY = dt.date(2024, 1, 1), dt.date(2030, 1, 1)
NO_AGENT, NO_AGENT_NAME = "-1", "Unassigned"


def dim_customers(stg_customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``as_of`` is the day the age is taken at; today by default."""
    today = F.current_date() if as_of is None else as_of
    age = years_between("date_of_birth", today).alias("customer_age")
    return stg_customers.select(
        "customer_id", "customer_name", "gender", "date_of_birth", "signup_date", "email", "address", age
    )


def dim_agents(stg_agents: DataFrame, unassigned: bool = False) -> DataFrame:
    """With ``unassigned`` one row is added for complaints without an agent."""
    agents = stg_agents.select("agent_id", "agent_name", "experience", "state")
    if not unassigned:
        return agents
    columns = "agent_id string, agent_name string, experience string, state string"
    row = stg_agents.sparkSession.createDataFrame([(NO_AGENT, NO_AGENT_NAME, None, None)], columns)
    return agents.unionByName(row)


def assign_agents(fact: DataFrame) -> DataFrame:
    """Point complaints without an agent at the unassigned one."""
    return fact.withColumn("agent_id", F.coalesce("agent_id", F.lit(NO_AGENT)))


def dim_channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name,) for name in CHANNELS], "channel string")


def dim_date(spark: SparkSession, first: dt.date = FIRST_DAY, end: dt.date = END_DAY) -> DataFrame:
    """One row per day from ``first`` up to but not including ``end``."""
    last = end - dt.timedelta(days=1)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date_day"))
    return days.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        month_name("date_day").alias("month_name"),
        day_of_week("date_day").alias("day_of_week"),
        F.quarter("date_day").alias("quarter"),
    )


def fct_calls(stg_call_logs: DataFrame) -> DataFrame:
    return stg_call_logs.select(
        "call_id",
        "customer_id",
        "agent_id",
        "call_logs_generation_date",
        "complaint_category",
        "resolution_status",
        "call_start_time",
        "call_end_time",
        seconds_between("call_start_time", "call_end_time").alias("call_duration_seconds"),
    )


def fct_web_complaints(stg_web_complaints: DataFrame) -> DataFrame:
    return stg_web_complaints.select(
        "request_id",
        "customer_id",
        "agent_id",
        "web_form_generation_date",
        "complaint_category",
        "resolution_status",
        "request_date",
        "resolution_date",
        hours_between("request_date", "resolution_date").alias("time_to_resolve_hours"),
    )


def fct_social_media(stg_social_media: DataFrame) -> DataFrame:
    return stg_social_media.select(
        "complaint_id",
        "customer_id",
        "agent_id",
        "media_complaint_generation_date",
        "media_channel",
        "complaint_category",
        "resolution_status",
        "request_date",
        "resolution_date",
        hours_between("request_date", "resolution_date").alias("time_to_resolve_hours"),
    )


def _complaints(staged: DataFrame, source_id: str, channel: str, started: str, ended: str) -> DataFrame:
    return staged.select(
        F.col(source_id).alias("source_complaint_id"),
        "customer_id",
        "agent_id",
        F.lit(channel).alias("channel"),
        "complaint_category",
        F.col("resolution_status").alias("status"),
        F.col(started).alias("started_at"),
        F.col(ended).alias("ended_at"),
        F.col(AUDIT).alias("ingested_at"),
    )


def fct_unified_complaints(
    stg_call_logs: DataFrame,
    stg_web_complaints: DataFrame,
    stg_social_media: DataFrame,
    since: dt.datetime | None = None,
    include_since: bool = False,
) -> DataFrame:
    """All complaints of the three channels with a hashed key.

    With ``since`` only rows ingested later; Spark pushes that filter below the union into every scan.
    Rows ingested exactly then are left out unless ``include_since``.
    """
    calls, web, social = CHANNELS
    complaints = (
        _complaints(stg_call_logs, "call_id", calls, "call_start_time", "call_end_time")
        .unionByName(_complaints(stg_web_complaints, "request_id", web, "request_date", "resolution_date"))
        .unionByName(_complaints(stg_social_media, "complaint_id", social, "request_date", "resolution_date"))
    )
    if since is not None:
        ingested, mark = F.col("ingested_at"), F.lit(since).cast("timestamp_ntz")
        complaints = complaints.where(ingested >= mark if include_since else ingested > mark)
    return complaints.select(surrogate_key("source_complaint_id", "channel").alias("complaint_pk"), "*")


def high_water_mark(fact: DataFrame) -> dt.datetime | None:
    """Latest ingestion time in the fact; ``None`` for an empty one, which then loads everything."""
    return fact.agg(F.max("ingested_at")).first()[0]


def refresh_unified(
    table: VersionedTable,
    stg_call_logs: DataFrame,
    stg_web_complaints: DataFrame,
    stg_social_media: DataFrame,
    include_since: bool = False,
) -> int:
    """Bring the incremental fact up to date: rows past its high-water mark, replaced by key."""
    since = high_water_mark(table.read())
    fresh = fct_unified_complaints(
        stg_call_logs, stg_web_complaints, stg_social_media, since, include_since
    )
    return table.merge(fresh, order_by="ingested_at")
