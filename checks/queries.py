"""Every operator of the engine as a query over the test tables.

Each takes ``(spark, sf_dir)`` and returns a frame. Operators that write do so in fresh folders below the
shared folder and return what a reader then sees.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters
from ombuds.operators import quality
from ombuds.operators.clustered import read_clustered, write_clustered
from ombuds.operators.dedup import latest_per_key
from ombuds.operators.tables import VersionedTable
from ombuds.operators.upsert import upsert
from ombuds.plans import analytics, erasure, marts, pipeline, staging
from ombuds.schemas import AGENTS, AUDIT, CALL_CENTER_LOGS, CUSTOMERS, RAW_TABLES, SOCIAL_MEDIA, UNIFIED, WEB_COMPLAINTS
from ombuds.session import conf, configure, freeing_shuffles, move_path, remove_path, scratch
from ombuds.sources import files, landing
from ombuds.sources.paths import AGENT_SHEET, CALL_LOGS, MEDIA, STATIC, WEB_FORMS
from ombuds.sources.stage import list_files, read_staged
from ombuds.streaming.daily import load_available, quarantined

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2025, 11, 20)
RUN_TIME = dt.datetime(2025, 11, 21, 6, 0, 0)
SECOND_RUN = dt.datetime(2025, 11, 22, 6, 0, 0)
#: days that part the tables into an earlier state and a later delivery
SPLIT, UNIFIED_SPLIT = "1998-01-01", "1999-01-01"
BUCKETS = 8

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def _before(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col(AUDIT) < F.lit(day).cast("timestamp_ntz"))


def _since(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col(AUDIT) >= F.lit(day).cast("timestamp_ntz"))


def _web_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(adapters.web_complaints(spark, sf_dir), "request_id")


def _staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "stg_call_logs": staging.stg_call_logs(adapters.call_center_logs(spark, sf_dir)),
        "stg_web_complaints": staging.stg_web_complaints(_web_latest(spark, sf_dir)),
        "stg_social_media": staging.stg_social_media(adapters.social_media(spark, sf_dir)),
    }


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_unified_complaints(**_staged(spark, sf_dir))


def _stored_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified fact as a stored table, as its readers find it."""
    fact = _unified(spark, sf_dir)
    table = VersionedTable(spark, scratch(spark, "unified"), fact.schema)
    table.replace(fact)
    return table.read()


# Staging


@query
def stg_customers(spark, sf_dir):
    return staging.stg_customers(adapters.customers(spark, sf_dir))


@query
def stg_agents(spark, sf_dir):
    return staging.stg_agents(adapters.agents(spark, sf_dir))


@query
def stg_call_logs(spark, sf_dir):
    return staging.stg_call_logs(adapters.call_center_logs(spark, sf_dir))


@query
def stg_web_complaints(spark, sf_dir):
    return staging.stg_web_complaints(adapters.web_complaints(spark, sf_dir))


@query
def stg_social_media(spark, sf_dir):
    return staging.stg_social_media(adapters.social_media(spark, sf_dir))


# Dimensions and facts


@query
def dim_customers(spark, sf_dir):
    return marts.dim_customers(stg_customers(spark, sf_dir), F.lit(AS_OF))


@query
def dim_agents(spark, sf_dir):
    return marts.dim_agents(stg_agents(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    """The calendar with the number of complaints started on each day."""
    day = F.to_date("started_at").alias("date_day")
    started = _unified(spark, sf_dir).groupBy(day).agg(F.count(F.lit(1)).alias("complaints"))
    # Days outside the calendar, and complaints without a day, keep their counts beside an empty calendar row.
    calendar = marts.dim_date(spark).join(started, "date_day", "full")
    return calendar.withColumn("complaints", F.coalesce("complaints", F.lit(0).cast("bigint")))


@query
def dim_channels(spark, sf_dir):
    """The channel list with the number of complaints of each."""
    counts = _unified(spark, sf_dir).groupBy("channel").agg(F.count(F.lit(1)).alias("complaints"))
    return marts.dim_channels(spark).join(counts, "channel", "left")


@query
def fct_calls(spark, sf_dir):
    return marts.fct_calls(stg_call_logs(spark, sf_dir))


@query
def fct_web_complaints(spark, sf_dir):
    return marts.fct_web_complaints(stg_web_complaints(spark, sf_dir))


@query
def fct_social_media(spark, sf_dir):
    return marts.fct_social_media(stg_social_media(spark, sf_dir))


@query
def fct_unified_complaints(spark, sf_dir):
    return _unified(spark, sf_dir)


@query
def unified_incremental(spark, sf_dir):
    """Rows past the high-water mark of an earlier state."""
    staged = _staged(spark, sf_dir)
    fact = marts.fct_unified_complaints(**staged)
    earlier = fact.where(F.col("ingested_at") < F.lit(UNIFIED_SPLIT).cast("timestamp_ntz"))
    return marts.fct_unified_complaints(**staged, since=marts.high_water_mark(earlier))


def _refreshed_twice(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """The stored fact after a first build and one incremental refresh."""
    path = scratch(spark, "unified")
    table = VersionedTable(spark, path, UNIFIED, "complaint_pk", BUCKETS, cluster="started_at")
    raw = {
        "stg_call_logs": adapters.call_center_logs(spark, sf_dir),
        "stg_web_complaints": adapters.web_complaints(spark, sf_dir),
        "stg_social_media": adapters.social_media(spark, sf_dir),
    }
    for cut in (lambda df: _before(df, UNIFIED_SPLIT), lambda df: df):
        # Stored, so that their dedup isn't on disk together with that of the fact.
        web = VersionedTable(spark, scratch(spark, "web"), WEB_COMPLAINTS.schema, "request_id", BUCKETS)
        web.merge(cut(raw["stg_web_complaints"]))
        marts.refresh_unified(
            table,
            staging.stg_call_logs(cut(raw["stg_call_logs"])),
            staging.stg_web_complaints(web.read()),
            staging.stg_social_media(cut(raw["stg_social_media"])),
        )
        remove_path(spark, web.root)
    return table


@query
def unified_upsert(spark, sf_dir):
    """The stored fact after a first build and one incremental refresh."""
    return _refreshed_twice(spark, sf_dir).read()


@query
def fact_day_range(spark, sf_dir):
    """Complaints started in some months around the second refresh, read from the files of those days only."""
    return _refreshed_twice(spark, sf_dir).read_between(dt.date(1998, 11, 1), dt.date(1999, 2, 28))


@query
def unified_clustered(spark, sf_dir):
    """Complaints per day, read from the fact laid out by day."""
    path = scratch(spark, "clustered")
    write_clustered(_unified(spark, sf_dir), path)
    return read_clustered(spark, path).groupBy("started_date").agg(F.count(F.lit(1)).alias("complaints"))


# Dedup, merge and swap


@query
def dedup_latest(spark, sf_dir):
    return _web_latest(spark, sf_dir)


@query
def merge_calls_partial(spark, sf_dir):
    """Matched calls take over four columns; the rest of a changed delivery is ignored."""
    calls = adapters.call_center_logs(spark, sf_dir)
    source = latest_per_key(_changed_calls(calls), CALL_CENTER_LOGS.merge_key)
    target = _before(calls, UNIFIED_SPLIT)
    return upsert(target, source, CALL_CENTER_LOGS.merge_key, CALL_CENTER_LOGS.update)


def _changed_calls(calls: DataFrame) -> DataFrame:
    changed = (
        _since(calls, SPLIT)
        .withColumn(AUDIT, F.when(F.col("resolutionstatus") != "Backlog", F.col(AUDIT)))
        .withColumn("resolutionstatus", F.lit("Resolved"))
        .withColumn("agent_id", F.lit("changed"))
        .withColumn("call_id", F.concat("call_id", F.lit("-b")))
    )
    return pipeline.fill_audit(changed, RUN_TIME, only_missing=True)


@query
def merge_web_full(spark, sf_dir):
    web = adapters.web_complaints(spark, sf_dir)
    target = latest_per_key(_before(web, SPLIT), "request_id")
    source = latest_per_key(_since(web, SPLIT), "request_id")
    return upsert(target, source, "request_id", unique_target=True)


@query
def merge_social_full(spark, sf_dir):
    """New NULLs overwrite old values."""
    social = adapters.social_media(spark, sf_dir)
    batch = (
        _since(social, "2024-01-10")
        .withColumn("agent_id", F.lit(None).cast("string"))
        .withColumn("resolutionstatus", F.lit("Resolved"))
    )
    source = latest_per_key(pipeline.fill_audit(batch, RUN_TIME), "complaint_id")
    return upsert(_before(social, "2024-01-20"), source, SOCIAL_MEDIA.merge_key, SOCIAL_MEDIA.update)


@query
def merge_web_table(spark, sf_dir):
    """The same merge as ``merge_web_full`` into a stored table of several buckets."""
    web = adapters.web_complaints(spark, sf_dir)
    table = VersionedTable(spark, scratch(spark, "web"), WEB_COMPLAINTS.schema, "request_id", BUCKETS)
    table.merge(_before(web, SPLIT))
    table.merge(_since(web, SPLIT))
    return table.read()


@query
def merge_calls_table(spark, sf_dir):
    """``merge_calls_partial`` into a stored table, and after it a batch of new calls, for which no stored key is scanned."""
    calls = adapters.call_center_logs(spark, sf_dir)
    key = CALL_CENTER_LOGS.merge_key
    table = VersionedTable(spark, scratch(spark, "calls"), CALL_CENTER_LOGS.schema, key, BUCKETS)
    table.merge(_before(calls, UNIFIED_SPLIT), CALL_CENTER_LOGS.update)
    table.merge(_changed_calls(calls), CALL_CENTER_LOGS.update)
    table.merge(calls.withColumn(key, F.concat(F.lit("new-"), key)), CALL_CENTER_LOGS.update)
    return table.read()


@query
def full_refresh_swap(spark, sf_dir):
    """A static table after its second full refresh."""
    customers = adapters.customers(spark, sf_dir)
    table = VersionedTable(spark, scratch(spark, "customers"), CUSTOMERS.schema)
    table.replace(pipeline.fill_audit(customers, RUN_TIME), check=quality.require_rows)
    table.replace(pipeline.fill_audit(customers, SECOND_RUN), check=quality.require_rows)
    return table.read()


@query
def erase_customer(spark, sf_dir):
    """The stored calls after erasing the customers whose birth date is unreadable."""
    table = VersionedTable(spark, scratch(spark, "calls"), CALL_CENTER_LOGS.schema, "call_id", BUCKETS)
    table.replace(adapters.call_center_logs(spark, sf_dir))
    unreadable = stg_customers(spark, sf_dir).where(F.col("date_of_birth").isNull()).select("customer_id")
    table.erase(unreadable, "customer_id")
    return table.read()


# Landing


@query
def land_csv_all_string(spark, sf_dir):
    """Customers through a CSV file with odd headers, quotes and line breaks inside fields."""
    address = F.concat(F.lit('Unit "'), "address", F.lit('",\n'), "gender")
    customers = adapters.customers(spark, sf_dir).drop("load_time", AUDIT).withColumn("address", address)
    lake, target = scratch(spark, "lake"), scratch(spark, "landed")
    odd = customers.toDF("customeR iD", "NamE", "gender ", "DATE of biRTH", "Signup-Date", "EMAIL", "ADDRESS")
    odd.write.csv(f"{lake}/customers/customers_dataset.csv", header=True, escape='"')
    done = landing.land(spark, lake, target, "STATIC", STATIC, run_time=RUN_TIME)
    return spark.read.parquet(done.path)


@query
def land_csv_call_logs(spark, sf_dir):
    """Calls through a day's CSV file whose first header is blank."""
    calls = adapters.call_center_logs(spark, sf_dir).drop("load_time", AUDIT)
    names = [
        "Unnamed: 0", "call ID", "customeR iD", "COMPLAINT_catego ry", "agent ID", "call_start_time",
        "call_end_time", "resolutionstatus", "callLogsGenerationDate",
    ]
    lake, target = scratch(spark, "lake"), scratch(spark, "landed")
    calls.toDF(*names).write.csv(f"{lake}/call logs/call_logs_day_2025-11-20.csv", header=True, escape='"')
    done = landing.land(spark, lake, target, "2025-11-20", CALL_LOGS, run_time=RUN_TIME)
    return spark.read.parquet(done.path).drop(landing.DAY)


@query
def land_csv_mixed_headers(spark, sf_dir):
    """Calls through a day's folder of CSV files whose headers differ in order and spelling."""
    calls = adapters.call_center_logs(spark, sf_dir).drop("load_time", AUDIT)
    names = [
        "Unnamed: 0", "call ID", "customeR iD", "COMPLAINT_catego ry", "agent ID", "call_start_time",
        "call_end_time", "resolutionstatus", "callLogsGenerationDate",
    ]
    lake, target = scratch(spark, "lake"), scratch(spark, "landed")
    odd = calls.toDF(*names)
    part = F.pmod(F.xxhash64("call ID"), F.lit(3))
    shapes = (names, names[::-1], [names[4], *names[:4], *names[5:]])
    for number, order in enumerate(shapes):
        some = odd.where(part == number).select(*(F.col(f"`{name}`") for name in order))
        some = some.withColumnRenamed("call ID", "Call-id") if number == 1 else some
        some.write.mode("append").csv(f"{lake}/call logs/call_logs_day_2025-11-20.csv", header=True, escape='"')
    done = landing.land(spark, lake, target, "2025-11-20", CALL_LOGS, run_time=RUN_TIME)
    return spark.read.parquet(done.path).drop(landing.DAY).select(*calls.columns, landing.LOAD_TIME)


def _social_names(social: DataFrame) -> DataFrame:
    return social.drop("load_time", AUDIT).select(
        "complaint_id",
        F.col("customer_id").alias("customeR iD"),
        F.col("complaint_catego_ry").alias("COMPLAINT_catego ry"),
        F.col("agent_id").alias("agent ID"),
        "resolutionstatus",
        "request_date",
        F.when(F.col("resolutionstatus") == "Resolved", F.col("resolution_date")).alias("resolution_date"),
        "media_channel",
        F.col("mediacomplaintgenerationdate").alias("MediaComplaintGenerationDate"),
    )


def _write_documents(social: DataFrame, path: str, document) -> None:
    """One JSON file per two thousand complaints. ``document`` maps column names to a JSON value."""
    named = _social_names(social)
    parts = named.withColumn("part", F.call_function("div", F.col("complaint_id").cast("bigint"), F.lit(2000)))
    text = F.to_json(document(named.columns)).alias("value")
    with freeing_shuffles(social.sparkSession):
        parts.groupBy("part").agg(text).write.partitionBy("part").text(path)


@query
def land_json_transpose(spark, sf_dir):
    """Social complaints through ``{column: {row id: value}}`` files; NULL cells are absent from them."""

    def by_row_id(names):
        row_id = F.col("complaint_id")
        cells = (F.collect_list(F.struct(row_id, F.col(f"`{name}`"))) for name in names)
        return F.struct(*(F.map_from_entries(cell).alias(name) for cell, name in zip(cells, names)))

    lake, target = scratch(spark, "lake"), scratch(spark, "landed")
    path = f"{lake}/social_medias/media_complaint_day_2025-11-20.json"
    _write_documents(adapters.social_media(spark, sf_dir), path, by_row_id)
    done = landing.land(spark, lake, target, "2025-11-20", MEDIA, run_time=RUN_TIME)
    return spark.read.parquet(done.path).drop(landing.DAY)


@query
def land_json_lists(spark, sf_dir):
    """Social complaints through ``{column: [values]}`` files."""

    def as_lists(names):
        row = F.collect_list(F.struct(*(F.col(f"`{name}`") for name in names)))
        return F.struct(*(row.getField(name).alias(name) for name in names))

    path = scratch(spark, "lake")
    _write_documents(adapters.social_media(spark, sf_dir), path, as_lists)
    return files.read_json(spark, f"{path}/*")


@query
def land_json_records(spark, sf_dir):
    """Social complaints through files holding a list of records."""

    def as_records(names):
        return F.collect_list(F.struct(*(F.col(f"`{name}`") for name in names)))

    path = scratch(spark, "lake")
    _write_documents(adapters.social_media(spark, sf_dir), path, as_records)
    return files.read_json(spark, f"{path}/*")


@query
def land_sheet(spark, sf_dir):
    """Agents through the export of a spreadsheet."""
    lake, target = scratch(spark, "lake"), scratch(spark, "landed")
    agents = adapters.agents(spark, sf_dir).drop("load_time", AUDIT)
    agents.toDF("iD", "NamE", "experience", "state").write.csv(f"{lake}/agents/agents.csv", header=True)
    done = landing.land(spark, lake, target, "2025-11-20", AGENT_SHEET, run_time=RUN_TIME)
    return spark.read.parquet(done.path)


def _web_reader(sf_dir: str):
    """Stands in for a database: the day's table, with typed columns and its own spelling."""

    def read(spark: SparkSession, table: str) -> DataFrame:
        web = adapters.web_complaints(spark, sf_dir).drop("load_time", AUDIT)
        typed = web.withColumn("source_row_id", F.col("source_row_id").cast("bigint"))
        typed = typed.withColumn("customer_id", F.col("customer_id").cast("bigint"))
        return typed.withColumnsRenamed(
            {"source_row_id": "column1", "customer_id": "customeR iD", "resolutionstatus": "ResolutionStatus"}
        )

    return read


@query
def jdbc_daily(spark, sf_dir):
    """Web complaints through a relational reader."""
    target = scratch(spark, "landed")
    done = landing.land(
        spark, "", target, "2025-11-20", WEB_FORMS, run_time=RUN_TIME, table_reader=_web_reader(sf_dir)
    )
    return spark.read.parquet(done.path).drop(landing.DAY)


@query
def land_daily_overwrite(spark, sf_dir):
    """Rows per landed day after one of two days was landed again."""
    target = scratch(spark, "landed")
    for day in ("2025-11-20", "2025-11-21", "2025-11-20"):
        done = landing.land(
            spark, "", target, day, WEB_FORMS, run_time=RUN_TIME, table_reader=_web_reader(sf_dir)
        )
    days = spark.read.parquet(done.path).groupBy(F.col(landing.DAY).cast("string").alias("day"))
    return days.agg(F.count(F.lit(1)).alias("rows"))


@query
def land_empty_day(spark, sf_dir):
    """The rows of two landed days after one of them was landed again without rows."""
    target, reader = scratch(spark, "landed"), _web_reader(sf_dir)
    none = lambda session, name: reader(session, name).where("false")
    for day, rows in (("2025-11-20", reader), ("2025-11-21", reader), ("2025-11-20", none)):
        done = landing.land(spark, "", target, day, WEB_FORMS, run_time=RUN_TIME, table_reader=rows)
    return spark.read.parquet(done.path).withColumn(landing.DAY, F.col(landing.DAY).cast("string"))


# Staging scans


@query
def stage_by_name(spark, sf_dir):
    """Calls from files that differ in spelling, types and columns."""
    calls = adapters.call_center_logs(spark, sf_dir).drop(AUDIT)
    status, path = F.col("resolutionstatus"), scratch(spark, "landed")
    shouted = calls.where(status == "Resolved").toDF(*(name.upper() for name in calls.columns))
    typed = calls.where(status == "Backlog").withColumn("agent_id", F.col("agent_id").cast("bigint"))
    lacking = calls.where(status == "In-Progress").drop("agent_id")
    shouted.write.parquet(f"{path}/dt=1")
    typed.withColumn("not_in_table", F.lit(1)).write.parquet(f"{path}/dt=2")
    lacking.write.parquet(f"{path}/dt=3")
    return read_staged(spark, CALL_CENTER_LOGS, _paths(spark, path))


def _paths(spark: SparkSession, folder: str) -> list[str]:
    return [file.path for file in list_files(spark, folder).select("path").collect()]


@query
def case_variant_coalesce(spark, sf_dir):
    """Web complaints from files with one or two accepted spellings, and one spelling that is not."""
    web = adapters.web_complaints(spark, sf_dir).drop(AUDIT)
    status, path = F.col("resolutionstatus"), scratch(spark, "landed")
    one = web.where(status == "Resolved").withColumnRenamed("customer_id", "CUSTOMER_ID")
    one.withColumnRenamed("source_row_id", "Source_Row_Id").write.parquet(f"{path}/dt=1")
    with conf(spark, spark__sql__caseSensitive="true"):
        odd_agent = F.col("agent_id").cast("bigint") % 2 == 1
        two = web.where(status != "Resolved").withColumn("SOURCE_ROW_ID", F.col("source_row_id"))
        two = two.withColumn("source_row_id", F.when(odd_agent, F.col("source_row_id")))
        two.write.parquet(f"{path}/dt=2")
    return read_staged(spark, WEB_COMPLAINTS, _paths(spark, path))


@query
def skip_corrupt_file(spark, sf_dir):
    """Social complaints beside a file that is no Parquet."""
    path = scratch(spark, "landed")
    social = adapters.social_media(spark, sf_dir).drop(AUDIT)
    social.write.parquet(f"{path}/good")
    social.select("complaint_id").coalesce(1).write.text(f"{path}/bad")
    bad = spark.read.text(f"{path}/bad").inputFiles()
    return read_staged(spark, SOCIAL_MEDIA, [*_paths(spark, f"{path}/good"), *bad])


@query
def lineage_columns(spark, sf_dir):
    """Rows per channel that know the file they came from."""
    path = scratch(spark, "landed")
    adapters.social_media(spark, sf_dir).drop(AUDIT).write.parquet(path)
    rows = read_staged(spark, SOCIAL_MEDIA, _paths(spark, path), lineage=True)
    known = F.count_if(F.col("source_file").endswith(".parquet"))
    return rows.groupBy("media_channel").agg(F.count(F.lit(1)).alias("rows"), known.alias("with_file"))


# Incremental loads


def _write_landed_web(web: DataFrame, root: str, day: str) -> None:
    with freeing_shuffles(web.sparkSession):
        web.drop(AUDIT).write.parquet(f"{root}/raw/postgres/dt={day}")


@query
def load_new_files(spark, sf_dir):
    """Rows of the files the ledger does not know after a first load."""
    web = adapters.web_complaints(spark, sf_dir)
    house = pipeline.Warehouse(spark, scratch(spark, "landed"), scratch(spark, "house"), BUCKETS)
    _write_landed_web(_before(web, SPLIT), house.landed, "2025-11-20")
    pipeline.load_daily(house, WEB_COMPLAINTS, RUN_TIME)
    _write_landed_web(_since(web, SPLIT), house.landed, "2025-11-21")
    new = house.ledger("web_complaints").new_files(house.folder("web_complaints")).collect()
    return read_staged(spark, WEB_COMPLAINTS, [file.path for file in new])


@query
def load_daily(spark, sf_dir):
    """The RAW web table after two daily loads."""
    web = adapters.web_complaints(spark, sf_dir)
    house = pipeline.Warehouse(spark, scratch(spark, "landed"), scratch(spark, "house"), BUCKETS)
    _write_landed_web(_before(web, SPLIT), house.landed, "2025-11-20")
    pipeline.load_daily(house, WEB_COMPLAINTS, RUN_TIME)
    _write_landed_web(_since(web, SPLIT), house.landed, "2025-11-21")
    pipeline.load_daily(house, WEB_COMPLAINTS, SECOND_RUN)
    return house.raw("web_complaints").read()


@query
def load_after_bad_file(spark, sf_dir):
    """The RAW web table when a day's damaged file was skipped, put right and loaded the next time."""
    web = adapters.web_complaints(spark, sf_dir)
    house = pipeline.Warehouse(spark, scratch(spark, "landed"), scratch(spark, "house"), BUCKETS)
    _write_landed_web(_before(web, SPLIT), house.landed, "2025-11-20")
    day = f"{house.landed}/raw/postgres/dt=2025-11-21"
    _write_landed_web(web.where("false"), house.landed, "2025-11-19")
    damaged = spark.range(1).select(F.lit("damaged").alias("value")).coalesce(1)
    damaged.write.option("compression", "none").text(day)
    move_path(spark, spark.read.text(day).inputFiles()[0], f"{day}/part-0.parquet")
    first = pipeline.load_daily(house, WEB_COMPLAINTS, RUN_TIME)
    if [path.rsplit("/", 1)[1] for path in first.rejected] != ["part-0.parquet"]:
        raise AssertionError(f"one damaged file beside files without rows, but {first.rejected} were left out")
    remove_path(spark, day)
    _write_landed_web(_since(web, SPLIT), house.landed, "2025-11-21")
    pipeline.load_daily(house, WEB_COMPLAINTS, SECOND_RUN)
    return house.raw("web_complaints").read()


@query
def load_static_bad_file(spark, sf_dir):
    """The RAW customers after a refresh that a damaged file stopped: those of the load before."""
    house = pipeline.Warehouse(spark, scratch(spark, "landed"), scratch(spark, "house"), BUCKETS)
    customers, folder = adapters.customers(spark, sf_dir).drop(AUDIT), house.folder("customers")
    customers.write.parquet(f"{folder}/part=1")
    pipeline.load_static(house, CUSTOMERS, RUN_TIME)
    damaged = spark.range(1).select(F.lit("damaged").alias("value")).coalesce(1)
    damaged.write.option("compression", "none").text(f"{folder}/part=2")
    move_path(spark, spark.read.text(f"{folder}/part=2").inputFiles()[0], f"{folder}/part=2/bad.parquet")
    second = pipeline.load_static(house, CUSTOMERS, SECOND_RUN)
    if (second.loaded, len(second.rejected)) != (0, 1):
        raise AssertionError(f"the damaged file should have stopped the refresh, but {second}")
    return house.raw("customers").read()


@query
def stream_daily_load(spark, sf_dir):
    """The same two loads through a file stream."""
    web = adapters.web_complaints(spark, sf_dir)
    landed, checkpoint = scratch(spark, "landed"), scratch(spark, "checkpoint")
    table = VersionedTable(spark, scratch(spark, "web"), WEB_COMPLAINTS.schema, "request_id", BUCKETS)
    parts = [(_before(web, SPLIT), "2025-11-20", RUN_TIME), (_since(web, SPLIT), "2025-11-21", SECOND_RUN)]
    for part, day, run_time in parts:
        _write_landed_web(part, landed, day)
        load_available(spark, WEB_COMPLAINTS, f"{landed}/raw/postgres", table, checkpoint, run_time)
    return table.read()


def _loaded_house(spark: SparkSession, sf_dir: str) -> pipeline.Warehouse:
    """All five sources from their files to RAW tables."""
    lake, day = scratch(spark, "lake"), "2025-11-20"
    house = pipeline.Warehouse(spark, scratch(spark, "landed"), scratch(spark, "house"), BUCKETS)
    _write_sources(spark, sf_dir, lake, day)
    for source in (STATIC, AGENT_SHEET, CALL_LOGS, WEB_FORMS, MEDIA):
        landing.land(
            spark, lake, house.landed, day, source, run_time=RUN_TIME, table_reader=_web_reader(sf_dir)
        )
    remove_path(spark, lake)  # nothing reads the sources any more
    for table in (CUSTOMERS, AGENTS):
        pipeline.load_static(house, table, RUN_TIME)
    for table in (CALL_CENTER_LOGS, WEB_COMPLAINTS, SOCIAL_MEDIA):
        pipeline.load_daily(house, table, RUN_TIME)
    return house


@query
def stream_unified(spark, sf_dir):
    """The unified fact of web complaints that two runs of the stream keep up to date with the RAW table."""
    web = adapters.web_complaints(spark, sf_dir)
    landed, checkpoint = scratch(spark, "landed"), scratch(spark, "checkpoint")
    table = VersionedTable(spark, scratch(spark, "web"), WEB_COMPLAINTS.schema, "request_id", BUCKETS)
    fact = VersionedTable(spark, scratch(spark, "unified"), UNIFIED, "complaint_pk", BUCKETS, cluster="started_at")
    parts = [(_before(web, SPLIT), "2025-11-20", RUN_TIME), (_since(web, SPLIT), "2025-11-21", SECOND_RUN)]
    for part, day, run_time in parts:
        _write_landed_web(part, landed, day)
        load_available(spark, WEB_COMPLAINTS, f"{landed}/raw/postgres", table, checkpoint, run_time, fact)
    return fact.read()


def _put_right(web: DataFrame, day: str) -> None:
    """Deliver a day's rows, the first file under the name of a damaged one. All rows of a request are in one file, so that it
    doesn't matter which file is loaded first."""
    spark = web.sparkSession
    late = scratch(spark, "late")
    web.repartition("request_id").write.parquet(late)
    move_path(spark, late, day)
    move_path(spark, spark.read.parquet(day).inputFiles()[0], f"{day}/part-0.parquet")


@query
def stream_bad_file(spark, sf_dir):
    """The RAW web table of a stream that met a damaged file, and took it once it was put right."""
    web = adapters.web_complaints(spark, sf_dir)
    landed, checkpoint = scratch(spark, "landed"), scratch(spark, "checkpoint")
    table = VersionedTable(spark, scratch(spark, "web"), WEB_COMPLAINTS.schema, "request_id", BUCKETS)
    folder, day = f"{landed}/raw/postgres", f"{landed}/raw/postgres/dt=2025-11-21"
    _write_landed_web(_before(web, SPLIT), landed, "2025-11-20")
    damaged = spark.range(1).select(F.lit("damaged").alias("value")).coalesce(1)
    damaged.write.option("compression", "none").text(day)
    move_path(spark, spark.read.text(day).inputFiles()[0], f"{day}/part-0.parquet")
    load_available(spark, WEB_COMPLAINTS, folder, table, checkpoint, RUN_TIME)
    if quarantined(spark, table).count() != 1:
        raise AssertionError("the damaged file should be in quarantine")
    remove_path(spark, day)
    _put_right(_since(web, SPLIT).drop(AUDIT), day)
    load_available(spark, WEB_COMPLAINTS, folder, table, checkpoint, SECOND_RUN)
    return table.read()


@query
def pipeline_end_to_end(spark, sf_dir):
    """All five sources from their files to the unified fact: complaints per channel and status."""
    house = _loaded_house(spark, sf_dir)
    pipeline.build_marts(house, AS_OF)
    groups = pipeline.read_marts(house)[pipeline.FACT].groupBy("channel", "status")
    return groups.agg(F.count(F.lit(1)).alias("complaints"), F.max("started_at").alias("last_started"))


@query
def gate_blocks_bad_marts(spark, sf_dir):
    """Rows of all seven marts after a second build that its tests stopped: those of the build before."""
    house = _loaded_house(spark, sf_dir)
    pipeline.build_marts(house, AS_OF)
    customers = house.raw("customers").read()
    house.raw("customers").replace(customers.unionByName(customers))
    calls = house.raw("call_center_logs").read().withColumn(AUDIT, F.lit(SECOND_RUN).cast("timestamp_ntz"))
    house.raw("call_center_logs").merge(calls.withColumn("call_id", F.concat("call_id", F.lit("-more"))))
    try:
        pipeline.build_marts(house, AS_OF)
    except pipeline.FailedTests:
        return quality.row_counts(pipeline.read_marts(house))
    raise AssertionError("customers twice over should have stopped the build")


@query
def erase_customer_everywhere(spark, sf_dir):
    """Rows per layer, of erased customers and of others, after those with an unreadable birth date were erased."""
    house = _loaded_house(spark, sf_dir)
    pipeline.build_marts(house, AS_OF)
    born = stg_customers(spark, sf_dir)
    unreadable = born.where(F.col("date_of_birth").isNull()).select("customer_id")
    erasure.erase_customers(house, unreadable)
    for table in (CALL_CENTER_LOGS, WEB_COMPLAINTS, SOCIAL_MEDIA):
        done = pipeline.load_daily(house, table, SECOND_RUN)
        if done != pipeline.Load():
            raise AssertionError(f"rewritten files of {table.name} should not be new, but {done}")
    return erasure.rows_per_layer(house, unreadable)


def _all_agents(spark: SparkSession, sf_dir: str, agents: DataFrame) -> DataFrame:
    """``agents``, and those that calls name besides: small tables have fewer suppliers than calls have agents."""
    named = adapters.call_center_logs(spark, sf_dir).select(F.col("agent_id").alias("id")).distinct()
    return agents.unionByName(named.join(agents, "id", "left_anti"), allowMissingColumns=True)


def _write_sources(spark: SparkSession, sf_dir: str, lake: str, day: str) -> None:
    quoted = {"header": True, "escape": '"'}
    for name, path in (
        ("customers", "customers/customers_dataset.csv"),
        ("agents", "agents/agents.csv"),
        ("call_center_logs", f"call logs/call_logs_day_{day}.csv"),
    ):
        rows = adapters.RAW[name](spark, sf_dir).drop("load_time", AUDIT)
        rows = _all_agents(spark, sf_dir, rows) if name == "agents" else rows
        rows.write.csv(f"{lake}/{path}", **quoted)

    def as_lists(names):
        row = F.collect_list(F.struct(*(F.col(f"`{name}`") for name in names)))
        return F.struct(*(row.getField(name).alias(name) for name in names))

    path = f"{lake}/social_medias/media_complaint_day_{day}.json"
    _write_documents(adapters.social_media(spark, sf_dir), path, as_lists)


@query
def load_metrics(spark, sf_dir):
    """Rows per layer, to reconcile them."""
    staged = _staged(spark, sf_dir)
    return quality.row_counts(
        {
            "web_delivered": adapters.web_complaints(spark, sf_dir),
            "web_raw": _web_latest(spark, sf_dir),
            **staged,
            "fct_unified_complaints": marts.fct_unified_complaints(**staged),
        }
    )


@query
def reconcile_layers(spark, sf_dir):
    """Rows per layer, as told by the writes themselves: web complaints came in two loads, customers were refreshed twice,
    and the marts were built twice."""
    house = _loaded_house(spark, sf_dir)
    pipeline.load_static(house, CUSTOMERS, SECOND_RUN)
    pipeline.build_marts(house, AS_OF)
    _write_landed_web(_since(adapters.web_complaints(spark, sf_dir), SPLIT), house.landed, "2025-11-21")
    pipeline.load_daily(house, WEB_COMPLAINTS, SECOND_RUN)
    pipeline.build_marts(house, AS_OF)
    return pipeline.reconciled(house)


# Data quality


@query
def dq_unique(spark, sf_dir):
    """Repeated request ids as delivered and after dedup."""
    delivered = quality.unique(adapters.web_complaints(spark, sf_dir), "delivered", "request_id")
    return delivered.unionByName(quality.unique(_web_latest(spark, sf_dir), "raw", "request_id"))


@query
def dq_duplicate_keys(spark, sf_dir):
    """The repeated request ids themselves."""
    return quality.duplicate_keys(adapters.web_complaints(spark, sf_dir), "request_id")


@query
def dq_not_null(spark, sf_dir):
    calls = stg_call_logs(spark, sf_dir)
    return quality.not_null(calls, "stg_call_logs", ["call_id", "call_start_time", "call_end_time"])


@query
def dq_relationships(spark, sf_dir):
    """Calls whose agent is missing from a list of senior agents, and calls without a known customer."""
    calls = fct_calls(spark, sf_dir)
    senior = dim_agents(spark, sf_dir).where(F.col("experience") == "Senior")
    customers = dim_customers(spark, sf_dir)
    orphans = quality.relationships(calls, "fct_calls", "agent_id", senior, "agent_id")
    return orphans.unionByName(
        quality.relationships(calls, "fct_calls", "customer_id", customers, "customer_id")
    )


@query
def dq_orphan_rows(spark, sf_dir):
    """The calls of agents missing from the list of senior agents."""
    senior = dim_agents(spark, sf_dir).where(F.col("experience") == "Senior")
    return quality.orphan_rows(fct_calls(spark, sf_dir), "agent_id", senior, "agent_id")


@query
def dq_accepted_values(spark, sf_dir):
    two = quality.CHANNELS[:2]
    return quality.accepted_values(_unified(spark, sf_dir), "fct_unified_complaints", "channel", two)


@query
def dq_suite(spark, sf_dir):
    """All tests declared for the RAW tables."""
    raw = {name: adapters.RAW[name](spark, sf_dir) for name in RAW_TABLES}
    return quality.run_suite(raw, quality.RAW_EXPECTATIONS)


@query
def dq_marts(spark, sf_dir):
    """All tests declared for the marts."""
    return pipeline.check_marts(
        {
            "dim_customers": dim_customers(spark, sf_dir),
            "dim_agents": dim_agents(spark, sf_dir),
            "fct_calls": fct_calls(spark, sf_dir),
            "fct_unified_complaints": _unified(spark, sf_dir),
        }
    )


# Analyst queries


@query
def failure_rate_by_category(spark, sf_dir):
    return analytics.failure_rate_by_category(fct_calls(spark, sf_dir))


@query
def handling_time_by_category(spark, sf_dir):
    return analytics.handling_time_by_category(fct_calls(spark, sf_dir))


@query
def multi_channel_customers(spark, sf_dir):
    return analytics.multi_channel_customers(_unified(spark, sf_dir), dim_customers(spark, sf_dir))


@query
def channel_hopping(spark, sf_dir):
    return analytics.channel_hopping(_stored_unified(spark, sf_dir), within_hours=24)


@query
def unassigned_agent(spark, sf_dir):
    """Complaints per agent level when social complaints have no agent."""
    social = F.col("channel") == quality.CHANNELS[2]
    fact = _unified(spark, sf_dir).withColumn("agent_id", F.when(~social, F.col("agent_id")))
    per_agent = marts.assign_agents(fact).groupBy("agent_id").agg(F.count(F.lit(1)).alias("complaints"))
    agents = marts.dim_agents(stg_agents(spark, sf_dir), unassigned=True)
    return per_agent.join(agents, "agent_id", "left").select("agent_id", "agent_name", "experience", "complaints")
