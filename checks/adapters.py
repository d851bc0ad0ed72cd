"""RAW complaint tables projected from the generic test tables, in Spark and in DuckDB SQL.

The two sides are written independently of each other; both follow ``FIXTURES.md``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD_TIME = "2025-11-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _later(time: str, seconds: Column) -> Column:
    return F.col(time) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _cases(subject: str, pairs: dict[str, str]) -> Column:
    mapping = F.create_map(*(F.lit(part) for pair in pairs.items() for part in pair))
    return mapping[F.col(subject)]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), ((key * 7) % 18000).cast("int"))
    joined = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1500).cast("int"))
    return table(spark, sf_dir, "customer").select(
        _text(key).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(key % 97 == 0, "not-a-date").otherwise(_text(born)).alias("date_of_birth"),
        _text(joined).alias("signup_date"),
        F.concat(F.lit("c"), _text(key), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("address"),
        F.lit(LOAD_TIME).alias("load_time"),
        F.lit(LOAD_TIME).cast("timestamp_ntz").alias("_ingestion_time"),
    )


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    balance = F.col("s_acctbal")
    level = F.when(balance < 2000, "Junior").when(balance < 6000, "Mid").otherwise("Senior")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        _text(F.col("s_suppkey")).alias("id"),
        F.col("s_name").alias("name"),
        level.alias("experience"),
        F.col("n_name").alias("state"),
        F.lit(LOAD_TIME).alias("load_time"),
        F.lit(LOAD_TIME).cast("timestamp_ntz").alias("_ingestion_time"),
    )


def call_center_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    second = (key * 37) % 86400
    status = _cases("o_orderstatus", {"F": "Resolved", "O": "Backlog", "P": "In-Progress"})
    start = _text(_later("o_orderdate", second))
    end = _text(_later("o_orderdate", second + (key * 13) % 1800))
    return table(spark, sf_dir, "orders").select(
        _text(key).alias("source_row_id"),
        _text(key).alias("call_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("complaint_catego_ry"),
        _text(key % 100).alias("agent_id"),
        F.when(key % 89 == 0, "bad-ts").otherwise(start).alias("call_start_time"),
        F.when(key % 101 != 0, end).alias("call_end_time"),
        status.alias("resolutionstatus"),
        _text(F.to_date("o_orderdate")).alias("calllogsgenerationdate"),
        F.lit(LOAD_TIME).alias("load_time"),
        F.col("o_orderdate").alias("_ingestion_time"),
    )


def web_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As delivered: request ids repeat."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem")
    resolved = _later("l_shipdate", (F.col("l_partkey") * 53) % 200000)
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        _text(F.col("l_linenumber")).alias("source_row_id"),
        F.concat_ws("-", _text(F.col("l_orderkey")), _text(F.col("l_linenumber"))).alias("request_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("complaint_catego_ry"),
        _text(F.col("l_suppkey")).alias("agent_id"),
        F.when(F.col("l_linestatus") == "F", "Resolved").otherwise("Backlog").alias("resolutionstatus"),
        _text(F.col("l_shipdate")).alias("request_date"),
        _text(resolved).alias("resolution_date"),
        _text(F.to_date("l_shipdate")).alias("webformgenerationdate"),
        F.lit(LOAD_TIME).alias("load_time"),
        F.col("l_shipdate").alias("_ingestion_time"),
    )


def social_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        _text(key).alias("complaint_id"),
        _text(F.col("user_id")).alias("customer_id"),
        F.col("event_type").alias("complaint_catego_ry"),
        _text(key % 100).alias("agent_id"),
        F.when(key % 3 == 0, "Resolved").otherwise("Backlog").alias("resolutionstatus"),
        _text(F.col("ts")).alias("request_date"),
        _text(_later("ts", (key * 977) % 100000)).alias("resolution_date"),
        F.col("event_type").alias("media_channel"),
        _text(F.to_date("ts")).alias("mediacomplaintgenerationdate"),
        F.lit(LOAD_TIME).alias("load_time"),
        F.col("ts").alias("_ingestion_time"),
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "agents": agents,
    "call_center_logs": call_center_logs,
    "web_complaints": web_complaints,
    "social_media": social_media,
}

# The same tables in DuckDB SQL, as common table expressions.

SQL = {
    "customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_custkey % 97 = 0 THEN 'not-a-date'
                    ELSE CAST(DATE '1950-01-01' + CAST(c_custkey * 7 % 18000 AS INTEGER) AS VARCHAR)
               END AS date_of_birth,
               CAST(DATE '2020-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS VARCHAR) AS signup_date,
               'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, c_mktsegment AS address,
               '{LOAD_TIME}' AS load_time, TIMESTAMP '{LOAD_TIME}' AS _ingestion_time
        FROM customer""",
    "agents": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
               CASE WHEN s_acctbal < 2000 THEN 'Junior' WHEN s_acctbal < 6000 THEN 'Mid' ELSE 'Senior' END
                 AS experience,
               n_name AS state, '{LOAD_TIME}' AS load_time, TIMESTAMP '{LOAD_TIME}' AS _ingestion_time
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "call_center_logs": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS source_row_id, CAST(o_orderkey AS VARCHAR) AS call_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS complaint_catego_ry,
               CAST(o_orderkey % 100 AS VARCHAR) AS agent_id,
               CASE WHEN o_orderkey % 89 = 0 THEN 'bad-ts'
                    ELSE CAST(o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS VARCHAR) END
                 AS call_start_time,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL
                    ELSE CAST(o_orderdate + to_seconds(o_orderkey * 37 % 86400 + o_orderkey * 13 % 1800)
                              AS VARCHAR) END AS call_end_time,
               CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'Backlog' WHEN 'P' THEN 'In-Progress'
               END AS resolutionstatus,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS calllogsgenerationdate,
               '{LOAD_TIME}' AS load_time, o_orderdate AS _ingestion_time
        FROM orders""",
    "web_complaints": f"""
        SELECT CAST(l_linenumber AS VARCHAR) AS source_row_id,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS request_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, o_orderpriority AS complaint_catego_ry,
               CAST(l_suppkey AS VARCHAR) AS agent_id,
               CASE WHEN l_linestatus = 'F' THEN 'Resolved' ELSE 'Backlog' END AS resolutionstatus,
               CAST(l_shipdate AS VARCHAR) AS request_date,
               CAST(l_shipdate + to_seconds(l_partkey * 53 % 200000) AS VARCHAR) AS resolution_date,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS webformgenerationdate,
               '{LOAD_TIME}' AS load_time, l_shipdate AS _ingestion_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "social_media": f"""
        SELECT CAST(event_id AS VARCHAR) AS complaint_id, CAST(user_id AS VARCHAR) AS customer_id,
               event_type AS complaint_catego_ry, CAST(event_id % 100 AS VARCHAR) AS agent_id,
               CASE WHEN event_id % 3 = 0 THEN 'Resolved' ELSE 'Backlog' END AS resolutionstatus,
               CAST(ts AS VARCHAR) AS request_date,
               CAST(ts + to_seconds(event_id * 977 % 100000) AS VARCHAR) AS resolution_date,
               event_type AS media_channel, CAST(CAST(ts AS DATE) AS VARCHAR) AS mediacomplaintgenerationdate,
               '{LOAD_TIME}' AS load_time, ts AS _ingestion_time
        FROM events""",
}
