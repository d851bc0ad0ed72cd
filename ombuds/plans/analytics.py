"""Analyst queries over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ombuds.operators.quality import CHANNELS

# The status that counts as a failure, and how many customers the top report lists.
OPEN_STATUS = "Backlog"
TOP_CUSTOMERS = 20
CALLS = CHANNELS[0]


def failure_rate_by_category(fct_calls: DataFrame) -> DataFrame:
    """Share of calls still open, as text; ordered by that text, as the report always was.

    ``failure_pct`` is the same number for a numeric order.
    """
    is_open = F.when(F.col("resolution_status") == OPEN_STATUS, 1).otherwise(0)
    counts = fct_calls.groupBy("complaint_category").agg(
        F.count("call_id").alias("total_calls"), F.sum(is_open).alias("backlog_count")
    )
    share = F.try_divide(F.col("backlog_count"), F.col("total_calls"))
    rated = counts.withColumn("failure_pct", F.round(share * 100, 0).cast("bigint"))
    text = F.concat(F.col("failure_pct").cast("string"), F.lit("%"))
    return rated.withColumn("failure_rate", text).orderBy(F.desc("failure_rate"), "complaint_category")


def handling_time_by_category(fct_calls: DataFrame) -> DataFrame:
    minutes = F.round(F.avg("call_duration_seconds") / 60, 1)
    volumes = fct_calls.groupBy("complaint_category").agg(
        F.count("call_id").alias("call_volume"), minutes.alias("avg_minutes_per_call")
    )
    return volumes.orderBy(F.desc("avg_minutes_per_call"), "complaint_category")


def multi_channel_customers(
    unified: DataFrame, dim_customers: DataFrame, top: int = TOP_CUSTOMERS
) -> DataFrame:
    """Customers (by name) who used more than one channel, busiest first.

    Complaints are counted per customer and channel before the join, so what is joined has a few rows per
    customer, however many complaints one customer has.
    """
    per_channel = unified.groupBy("customer_id", "channel").agg(F.count(F.lit(1)).alias("complaints"))
    named = per_channel.join(dim_customers.select("customer_id", "customer_name"), "customer_id")
    totals = named.groupBy("customer_name", "channel").agg(F.sum("complaints").alias("complaints"))
    customers = totals.groupBy("customer_name").agg(
        F.count("channel").alias("channels_used"), F.sum("complaints").alias("total_interactions")
    )
    busiest = customers.where(F.col("channels_used") > 1)
    return busiest.orderBy(F.desc("total_interactions"), "customer_name").limit(top)


def channel_hopping(unified: DataFrame, within_hours: int = 24) -> DataFrame:
    """Web and social complaints followed by a call of the same customer within some hours.

    Each such complaint comes with the first call at or after it. No pairs are formed: the call is looked up
    once per customer and instant, among the later instants of that minute, and failing that among the first
    calls of the customer's later minutes. Rows of one instant are merged before any shuffle, so a minute is
    bounded by the clock and a customer by the calendar, however many rows share a customer or a time.
    """
    known = unified.where(F.col("customer_id").isNotNull() & F.col("started_at").isNotNull())
    rows = known.select("complaint_pk", "customer_id", "channel", "started_at")
    is_call = F.col("channel") == CALLS
    call_pk = F.min(F.when(is_call, F.col("complaint_pk"))).alias("call_pk")
    instants = rows.groupBy("customer_id", "started_at").agg(call_pk, F.bool_or(~is_call).alias("asks"))
    call = F.when(
        F.col("call_pk").isNotNull(), F.struct(F.col("started_at").alias("called_at"), F.col("call_pk"))
    )
    instants = instants.select("customer_id", "started_at", _minute("started_at").alias("minute"), "asks", call.alias("call"))

    from_here = _latest_first("customer_id", "minute", order="started_at", until=Window.currentRow)
    same_minute = instants.withColumn("own", F.last("call", ignorenulls=True).over(from_here))
    # The least of a minute's calls in ``own`` is its first call. Taken from there, it needs no shuffle besides the one before.
    minutes = same_minute.groupBy("customer_id", "minute").agg(F.min("own").alias("first_call"), F.bool_or("asks").alias("asks"))
    after = _latest_first("customer_id", order="minute", until=-1)
    later = minutes.withColumn("next", F.last("first_call", ignorenulls=True).over(after))
    # Calls that are too late for the whole minute go before the join, those too late for an instant after it.
    near = _minute("next.called_at") - F.col("minute") <= F.lit(within_hours) * 60 + 1
    later = later.where(F.col("asks") & near).select("customer_id", "minute", "next")
    deadline = F.col("started_at") + F.make_dt_interval(hours=F.lit(within_hours))
    found = (
        same_minute.where("asks")
        .join(later, ["customer_id", "minute"], "left")
        .select("customer_id", "started_at", F.coalesce("own", "next").alias("call"))
        .where(F.col("call.called_at") <= deadline)
    )
    complaints = rows.where(~is_call).join(found, ["customer_id", "started_at"])
    return complaints.select(
        "complaint_pk", "customer_id", "channel", "started_at", "call.call_pk", "call.called_at"
    )


def _latest_first(*keys: str, order: str, until: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, until)


def _minute(time: str) -> Column:
    """Minutes since 1970."""
    of_day = F.hour(time) * 60 + F.minute(time)
    return F.unix_date(F.to_date(time)).cast("bigint") * 1440 + of_day
