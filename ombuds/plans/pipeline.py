"""The jobs from landed files to marts."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.operators.clustered import write_clustered
from ombuds.operators.quality import MART_EXPECTATIONS, RAW_EXPECTATIONS, require_rows, run_suite
from ombuds.operators.tables import VersionedTable
from ombuds.plans import marts
from ombuds.plans.staging import STAGING
from ombuds.schemas import AUDIT, RAW_TABLES, UNIFIED, RawTable
from ombuds.session import freeing_shuffles, path_exists, remove_path, scratch
from ombuds.sources.landing import utc_now
from ombuds.sources.ledger import Ledger
from ombuds.sources.paths import RAW_FOLDERS
from ombuds.sources.stage import Staged, empty_files, list_files, stage_files

# The pipeline merges calls on their own id: the row number of a daily file restarts every day.
MERGE_KEYS = {"call_center_logs": "call_id"}


def fill_audit(df: DataFrame, run_time: dt.datetime, only_missing: bool = False) -> DataFrame:
    """Stamp the ingestion time on all rows, or only on rows without one."""
    now = F.lit(run_time).cast("timestamp_ntz")
    if only_missing and AUDIT in df.columns:
        return df.withColumn(AUDIT, F.coalesce(AUDIT, now))
    return df.withColumn(AUDIT, now)


class FailedTests(RuntimeError):
    """Declared tests of marts that failed."""


@dataclass(frozen=True)
class Warehouse:
    """Folders of one installation: landed files, RAW tables and marts."""

    spark: SparkSession
    landed: str
    root: str
    buckets: int = 64

    def raw(self, name: str) -> VersionedTable:
        table = RAW_TABLES[name]
        path = f"{self.root}/raw/{name}"
        if table.merge_key is None:
            return VersionedTable(self.spark, path, table.schema)
        key = MERGE_KEYS.get(name, table.merge_key)
        return VersionedTable(self.spark, path, table.schema, key, self.buckets)

    def unified(self) -> VersionedTable:
        path = f"{self.root}/marts/fct_unified_complaints"
        return VersionedTable(self.spark, path, UNIFIED, "complaint_pk", self.buckets, cluster="started_at")

    def ledger(self, name: str) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger/{name}")

    def folder(self, name: str) -> str:
        return f"{self.landed}/{RAW_FOLDERS[name]}"

    def staging(self) -> dict[str, DataFrame]:
        """The typed staging frames over the current RAW tables."""
        return {view: build(self.raw(name).read()) for name, (view, build) in STAGING.items()}


@dataclass(frozen=True)
class Load:
    """Outcome of a load: number of files loaded, and paths of files that could not be read to their end."""

    loaded: int = 0
    rejected: tuple[str, ...] = ()


def load_static(
    warehouse: Warehouse, table: RawTable, run_time: dt.datetime | None = None, partial: bool = False
) -> Load:
    """Load all files of a static source and swap the table; an empty load keeps the old one.

    If a file can't be read to its end, its rows would be missing from the new table. So nothing is loaded then, and
    readers keep the old table, unless ``partial`` asks for what can be read.
    """
    spark, folder = warehouse.spark, warehouse.folder(table.name)
    paths = [file.path for file in list_files(spark, folder).select("path").collect()]
    staged = stage_files(spark, table, paths)
    rejected = (*staged.rejected, *empty_files(spark, folder))
    if rejected and not partial:
        return Load(0, rejected)
    stamped = fill_audit(staged.rows, run_time or utc_now())
    version = warehouse.raw(table.name).replace(stamped, check=require_rows)
    record_load(warehouse, table, version, staged)
    staged.discard()
    return Load(len(paths) - len(staged.rejected), rejected)


def load_daily(warehouse: Warehouse, table: RawTable, run_time: dt.datetime | None = None) -> Load:
    """Load files not loaded before and merge them.

    A file that cannot be read to its end is skipped, reported, and not recorded: it stays new, so it is loaded once
    it is put right, or once a passing fault of the storage is over. A file without rows is loaded like any other.

    The ledger is written last: a run lost in between loads the same files again, and merging the same rows
    twice changes nothing.
    """
    run_time = run_time or utc_now()
    spark, ledger, folder = warehouse.spark, warehouse.ledger(table.name), warehouse.folder(table.name)
    listing = scratch(spark, "listing")
    ledger.new_files(folder).write.parquet(listing)
    files = spark.read.schema(ledger.listing_schema).parquet(listing)
    paths = [file.path for file in files.select("path").collect()]
    empty = tuple(empty_files(spark, folder))
    if not paths:
        return Load(0, empty)
    staged = stage_files(spark, table, paths)
    if len(staged.rejected) < len(paths):
        target = warehouse.raw(table.name)
        update = table.update if target.key == table.merge_key else _without_key(table, target.key)
        version = target.merge(fill_audit(staged.rows, run_time, only_missing=True), update)
        record_load(warehouse, table, version, staged)
        left_out = spark.createDataFrame([(path,) for path in staged.rejected], "path string")
        ledger.record(files.join(left_out, "path", "left_anti"), run_time)
    staged.discard()
    remove_path(spark, listing)
    return Load(len(paths) - len(staged.rejected), (*staged.rejected, *empty))


_LOADS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("rows", T.LongType()),
    ]
)


def record_load(warehouse: Warehouse, table: RawTable, version: int, staged: Staged) -> None:
    """Keep how many rows a load delivered, beside the version of the table that it made.

    The staged rows were written a moment ago, so this reads the counts in their footers. A load that runs again after it
    was lost delivers the same rows to the same table, and both are told.
    """
    row = (table.name, version, table.merge_key is None, staged.rows.count())
    log = warehouse.spark.createDataFrame([row], _LOADS).coalesce(1)
    log.write.mode("append").parquet(f"{warehouse.root}/loads")


def reconciled(warehouse: Warehouse) -> DataFrame:
    """``layer, table, rows``: rows delivered by loads, rows of the RAW tables, and rows of the marts of the last build.

    All of it is told by what each write left about itself, and no layer is read. A full refresh replaces what earlier
    ones delivered, daily loads add up.
    """
    spark, root = warehouse.spark, warehouse.root
    if not path_exists(spark, f"{root}/loads"):
        return spark.createDataFrame([], "layer string, `table` string, rows long")
    loads = spark.read.schema(_LOADS).parquet(f"{root}/loads")
    delivered = F.when(F.bool_or("whole"), F.max_by("rows", "version")).otherwise(F.sum("rows"))
    layers = [loads.groupBy("table").agg(delivered.alias("rows")).select(F.lit("delivered").alias("layer"), "table", "rows")]
    for name in RAW_TABLES:
        now = warehouse.raw(name).counts().agg(F.max_by("rows", "version").alias("rows"), F.max("version").alias("version"))
        now = now.where("version is not null")
        layers.append(now.select(F.lit("raw").alias("layer"), F.lit(name).alias("table"), "rows"))
    number = _last_build(warehouse)
    if number is not None:
        build = spark.read.schema(_BUILD).parquet(f"{root}/builds").where(F.col("build") == number)
        counted = reduce(
            DataFrame.unionByName, (table.counts().withColumn("mart", F.lit(name)) for name, (table, _) in _built(warehouse, number).items()),
        )
        found = build.join(counted, ["mart", "version"], "left")
        layers.append(found.select(F.lit("mart").alias("layer"), F.col("mart").alias("table"), "rows"))
    return reduce(DataFrame.unionByName, layers)


def _without_key(table: RawTable, key: str) -> tuple[str, ...] | None:
    if table.update is None:
        return None
    return tuple(name for name in table.update if name != key)


_BUILD = T.StructType(
    [
        T.StructField("build", T.LongType()),
        T.StructField("mart", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("columns", T.StringType()),
    ]
)
FACT = "fct_unified_complaints"


def build_marts(warehouse: Warehouse, as_of: dt.date | None = None) -> dict[str, str]:
    """Rebuild dimensions and channel facts, bring the unified fact up to date, and publish all seven together.

    The declared tests run on what was written. If one fails, ``FailedTests`` is raised, the tables go back to their
    versions before, and no build is recorded. A build is one small file that names a version of each mart, so
    ``read_mart`` never shows new dimensions beside an old fact.
    """
    staged = warehouse.staging()
    day = None if as_of is None else F.lit(as_of)
    frames = {
        "dim_customers": marts.dim_customers(staged["stg_customers"], day),
        "dim_agents": marts.dim_agents(staged["stg_agents"]),
        "dim_date": marts.dim_date(warehouse.spark),
        "fct_calls": marts.fct_calls(staged["stg_call_logs"]),
        "fct_web_complaints": marts.fct_web_complaints(staged["stg_web_complaints"]),
        "fct_social_media": marts.fct_social_media(staged["stg_social_media"]),
    }
    tables = {name: mart(warehouse, name, frame.schema) for name, frame in frames.items()}
    tables[FACT] = warehouse.unified()
    before = {name: table.version() for name, table in tables.items()}
    versions = {name: tables[name].replace(frame) for name, frame in frames.items()}
    channels = (staged[name] for name in ("stg_call_logs", "stg_web_complaints", "stg_social_media"))
    versions[FACT] = marts.refresh_unified(tables[FACT], *channels)
    written = {name: table.read(versions[name]) for name, table in tables.items()}
    with freeing_shuffles(warehouse.spark):
        failed = check_marts(written).where("failures > 0").collect()
    if failed:
        for name, table in tables.items():
            table.revert(before[name])
        raise FailedTests("; ".join(f"{row.test} of {row.table}.{row.column}: {row.failures}" for row in failed))
    record_build(warehouse, tables, versions)
    return {name: f"{warehouse.root}/marts/{name}" for name in tables}


def record_build(warehouse: Warehouse, tables: dict[str, VersionedTable], versions: dict[str, int]) -> int:
    """Publish versions of all marts together."""
    number = 1 + (_last_build(warehouse) or 0)
    rows = [(number, name, versions[name], table.schema.json()) for name, table in tables.items()]
    build = warehouse.spark.createDataFrame(rows, _BUILD).coalesce(1)
    build.write.mode("append").parquet(f"{warehouse.root}/builds")
    return number


def _last_build(warehouse: Warehouse) -> int | None:
    path = f"{warehouse.root}/builds"
    if not path_exists(warehouse.spark, path):
        return None
    return warehouse.spark.read.schema(_BUILD).parquet(path).agg(F.max("build")).first()[0]


def read_marts(warehouse: Warehouse) -> dict[str, DataFrame]:
    """All marts as of the last complete build."""
    number = _last_build(warehouse)
    if number is None:
        raise RuntimeError(f"{warehouse.root} has no complete build yet")
    return {name: table.read(version) for name, (table, version) in _built(warehouse, number).items()}


def _built(warehouse: Warehouse, number: int) -> dict[str, tuple[VersionedTable, int]]:
    """The tables of a build, and which version of each it names."""
    builds = warehouse.spark.read.schema(_BUILD).parquet(f"{warehouse.root}/builds")
    found = {row.mart: row for row in builds.where(F.col("build") == number).collect()}
    schemas = {name: T.StructType.fromJson(json.loads(row["columns"])) for name, row in found.items()}
    tables = {name: warehouse.unified() if name == FACT else mart(warehouse, name, schemas[name]) for name in found}
    return {name: (table, found[name].version) for name, table in tables.items()}


def mart(warehouse: Warehouse, name: str, schema: T.StructType) -> VersionedTable:
    return VersionedTable(warehouse.spark, f"{warehouse.root}/marts/{name}", schema)


def publish_clustered(warehouse: Warehouse) -> str:
    """Write the unified fact laid out by day for readers that select time ranges."""
    path = f"{warehouse.root}/marts/fct_unified_complaints_by_day"
    write_clustered(warehouse.unified().read(), path)
    return path


def check_raw(warehouse: Warehouse) -> DataFrame:
    return run_suite({name: warehouse.raw(name).read() for name in RAW_EXPECTATIONS}, RAW_EXPECTATIONS)


def check_marts(tables: dict[str, DataFrame]) -> DataFrame:
    return run_suite(tables, MART_EXPECTATIONS)
