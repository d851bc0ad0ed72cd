"""Typed staging views over the RAW tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ombuds.functions.casts import try_date, try_timestamp
from ombuds.schemas import AUDIT

# RAW column names that staging renames.
CATEGORY, STATUS = "complaint_catego_ry", "resolutionstatus"


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "gender",
        try_date("date_of_birth").alias("date_of_birth"),
        try_date("signup_date").alias("signup_date"),
        "email",
        "address",
        AUDIT,
    )


def stg_agents(agents: DataFrame) -> DataFrame:
    return agents.select(
        F.col("id").alias("agent_id"), F.col("name").alias("agent_name"), "experience", "state", AUDIT
    )


def stg_call_logs(calls: DataFrame) -> DataFrame:
    return calls.select(
        "call_id",
        "source_row_id",
        "customer_id",
        "agent_id",
        F.col(CATEGORY).alias("complaint_category"),
        F.col(STATUS).alias("resolution_status"),
        try_timestamp("call_start_time").alias("call_start_time"),
        try_timestamp("call_end_time").alias("call_end_time"),
        try_date("calllogsgenerationdate").alias("call_logs_generation_date"),
        AUDIT,
    )


def stg_web_complaints(web: DataFrame) -> DataFrame:
    return web.select(
        "request_id",
        "source_row_id",
        "customer_id",
        "agent_id",
        F.col(CATEGORY).alias("complaint_category"),
        F.col(STATUS).alias("resolution_status"),
        try_timestamp("request_date").alias("request_date"),
        try_timestamp("resolution_date").alias("resolution_date"),
        try_date("webformgenerationdate").alias("web_form_generation_date"),
        AUDIT,
    )


def stg_social_media(social: DataFrame) -> DataFrame:
    return social.select(
        "complaint_id",
        "customer_id",
        "agent_id",
        F.col(CATEGORY).alias("complaint_category"),
        "media_channel",
        F.col(STATUS).alias("resolution_status"),
        try_timestamp("request_date").alias("request_date"),
        try_timestamp("resolution_date").alias("resolution_date"),
        try_date("mediacomplaintgenerationdate").alias("media_complaint_generation_date"),
        AUDIT,
    )


STAGING = {
    "customers": ("stg_customers", stg_customers),
    "agents": ("stg_agents", stg_agents),
    "call_center_logs": ("stg_call_logs", stg_call_logs),
    "web_complaints": ("stg_web_complaints", stg_web_complaints),
    "social_media": ("stg_social_media", stg_social_media),
}


def register_views(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Build every staging frame whose RAW table is given and expose it as a view."""
    staged = {}
    for table, df in raw.items():
        name, build = STAGING[table]
        staged[name] = build(df)
        staged[name].createOrReplaceTempView(name)
    return staged
