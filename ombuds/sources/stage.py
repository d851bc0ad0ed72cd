"""Staging scan: landed Parquet files of any column types and spellings, as rows of a RAW table."""

from __future__ import annotations

import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.schemas import RawTable
from ombuds.session import conf, remove_path, shared_dir

SOURCE_FILE = "source_file"
_FOOTER_THREADS = 16
_SKIP_BAD = {"ignoreCorruptFiles": "true"}
_PLAIN = "plain"
#: Names of damaged files that are broadcast at most.
_FEW = 10_000


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length, modified)`` of every Parquet file below a folder. File contents are not read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet")
    return files.load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def empty_files(spark: SparkSession, folder: str) -> list[str]:
    """Parquet files of 0 bytes below a folder: broken off before anything was written, and hidden from every scan."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(folder)
    listed = {unquote(name).replace("file:///", "file:/", 1) for name in files.inputFiles()}  # these have them
    return sorted(listed - {row.path for row in files.select("path").collect()}) if listed else []


# Files of one schema


def group_by_schema(
    spark: SparkSession, files: list[str], exact: bool = False
) -> list[tuple[T.StructType, list[str]]]:
    """Split files into groups that one scan can read. Files without a readable footer are left out.

    Nearly always all files agree and one distributed footer merge shows it. Only when types or spellings
    differ are the footers looked at file by file. With ``exact`` spellings may differ: the scan takes columns by their exact
    names, so that each spelling is a column of its own, NULL in the files without it.
    """
    if not files:
        return []
    with conf(spark, spark__sql__caseSensitive="true"):
        merged = _merged_schema(spark, files)
        if merged is not None and (exact or not _spelled_twice(merged)):
            return [(merged, files)]
    schemas = _file_schemas(spark, files)
    groups: dict[str, list[str]] = defaultdict(list)
    kinds: dict[str, T.StructType] = {}
    for path, schema in zip(files, schemas):
        if schema is not None:
            kinds[schema.json()] = schema
            groups[schema.json()].append(path)
    return [(kinds[kind], paths) for kind, paths in groups.items()]


def _merged_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    try:
        return spark.read.options(mergeSchema="true", **_SKIP_BAD).parquet(*files).schema
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def _file_schemas(spark: SparkSession, files: list[str]) -> list[T.StructType | None]:
    """The schema of each file, looked at singly. Names are case-sensitive, as a file may have two spellings of a column."""
    with conf(spark, spark__sql__caseSensitive="true"), ThreadPoolExecutor(_FOOTER_THREADS) as pool:
        return list(pool.map(lambda path: _file_schema(spark, path), files))


def _file_schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return spark.read.options(**_SKIP_BAD).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _spelled_twice(schema: T.StructType) -> bool:
    return len({name.lower() for name in schema.fieldNames()}) < len(schema.fieldNames())


def _file() -> Column:
    return F.col("_metadata.file_path").alias(SOURCE_FILE)


def _plain_file() -> Column:
    """``_plain`` of the file a row came from, which is an encoded URI."""
    decoded = F.url_decode(F.replace(F.col(SOURCE_FILE), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/*", "/").alias(_PLAIN)


def _plain(path: str) -> str:
    """One spelling for local paths: ``file:/a``, ``file:///a`` and ``/a`` name the same file."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path


# Rows of the table


@dataclass(frozen=True)
class Staged:
    """Rows of files that were read to their end, with the file each came from, and the paths of the other files."""

    rows: DataFrame
    rejected: tuple[str, ...] = ()
    path: str | None = None

    def discard(self) -> None:
        """Delete the staged rows, when they are where they belong."""
        if self.path is not None:
            remove_path(self.rows.sparkSession, self.path)


def stage_files(spark: SparkSession, table: RawTable, files: list[str]) -> Staged:
    """Decode ``files`` once, into a staged table in the shared folder, and leave out those that are damaged.

    Skipping corrupt files while reading would keep the rows decoded before the fault. So each staged row has its file,
    and a file counts as read when it gave as many rows as its footer promises; the rows of the others go by an anti
    join. A file without rows promises none, so it is read. Nothing but the names of files reaches the driver.
    """
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    footers, filled, promised = [], [], 0
    for schema, paths in group_by_schema(spark, files, exact=table.spellings is not None):
        with _spelling(spark, schema):
            found = spark.read.schema(_needed(table, schema)).options(**_SKIP_BAD).parquet(*paths)
            _rows(found, table, schema, [_file()]).write.mode("append").option("compression", "zstd").parquet(path)
        # No column is read, so these are the footers' counts.
        footer = spark.read.schema(T.StructType(schema.fields[:1])).options(**_SKIP_BAD).parquet(*paths)
        footers.append(footer.select(_file()))
        seen = Observation()
        numbered = footer.select(_file(), F.col("_metadata.row_index").alias("row")).observe(seen, F.count(F.lit(1)).alias("rows"))
        filled += numbered.where("row = 0").select(SOURCE_FILE).collect()
        promised += seen.get["rows"] or 0
    columns = T.StructType([T.StructField(name, T.StringType()) for name in (*table.business, SOURCE_FILE)])
    if not footers:
        return Staged(spark.createDataFrame([], columns), tuple(sorted(files)))
    staged = spark.read.schema(columns).parquet(path)
    given = spark.createDataFrame([(file, _plain(file)) for file in files], f"path string, {_PLAIN} string")
    counted = spark.createDataFrame(filled, f"{SOURCE_FILE} string").select(_plain_file(), SOURCE_FILE)
    told = given.join(counted, _PLAIN, "left").select("path", SOURCE_FILE).collect()
    # No file gives more rows than it promises. So if all rows promised are there, which the footers of the staged rows tell,
    # each file gave its own; rows are counted by file only if some are missing.
    cut = set()
    if staged.count() != promised:
        promises = reduce(DataFrame.unionByName, footers).groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("promised"))
        decoded = staged.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("decoded"))
        less = promises.join(decoded, SOURCE_FILE, "left").where(F.col("promised") != F.coalesce("decoded", F.lit(0)))
        cut = {row[SOURCE_FILE] for row in less.select(SOURCE_FILE).collect()}
    # A file without a row in either count has none, or its footer can't be read; only such files are looked at singly.
    rowless = [row.path for row in told if row[SOURCE_FILE] is None]
    read = {file for file, schema in zip(rowless, _file_schemas(spark, rowless)) if schema is not None}
    broken = [row for row in told if row[SOURCE_FILE] in cut]
    if broken:
        names = spark.createDataFrame([(row[SOURCE_FILE],) for row in broken], f"{SOURCE_FILE} string")
        staged = staged.join(F.broadcast(names) if len(broken) <= _FEW else names, SOURCE_FILE, "left_anti")
    rejected = sorted([*(row.path for row in broken), *(path for path in rowless if path not in read)])
    return Staged(staged.select(*columns.names), tuple(rejected), path)


def read_staged(
    spark: SparkSession,
    table: RawTable,
    files: list[str],
    check_files: bool = True,
    lineage: bool = False,
) -> DataFrame:
    """Rows of ``files`` with the business columns of ``table``, all text; damaged files are left out.

    Without declared spellings a column is matched by name ignoring case. With them, a column takes the
    first non-NULL of its spellings and all other columns must be spelled as declared. Columns a file lacks
    are NULL and columns the table lacks are ignored. ``lineage`` adds the file a row came from.

    Without ``check_files`` the files are scanned where the result is, unless one of them has two spellings of a column,
    which can be told apart only while names are case-sensitive.
    """
    columns = [*table.business, SOURCE_FILE] if lineage else table.business
    if not check_files:
        groups = group_by_schema(spark, files)
        if groups and not any(_spelled_twice(_needed(table, schema)) for schema, _ in groups):
            parts = [
                _rows(spark.read.schema(_needed(table, schema)).parquet(*paths), table, schema, [_file()] if lineage else [])
                for schema, paths in groups
            ]
            return reduce(DataFrame.unionByName, parts)
    return stage_files(spark, table, files).rows.select(*columns)


def _needed(table: RawTable, schema: T.StructType) -> T.StructType:
    wanted = {name for names in _picked(table, schema).values() for name in names}
    return T.StructType([field for field in schema.fields if field.name in wanted])


def _spelling(spark: SparkSession, schema: T.StructType):
    """Names are case-sensitive while files with two spellings of a column are read."""
    return conf(spark, spark__sql__caseSensitive=str(_spelled_twice(schema)).lower())


def _rows(found: DataFrame, table: RawTable, schema: T.StructType, more: list[Column]) -> DataFrame:
    picked = _picked(table, schema)
    return found.select(*(_first_filled(names).alias(name) for name, names in picked.items()), *more)


def _picked(table: RawTable, schema: T.StructType) -> dict[str, list[str]]:
    """For every table column, the file columns it is filled from."""
    present = schema.fieldNames()
    if table.spellings is None:
        return {name: [found for found in present if found.lower() == name] for name in table.business}
    return {
        name: [spelling for spelling in table.spellings.get(name, (name,)) if spelling in present]
        for name in table.business
    }


def _first_filled(names: list[str]) -> Column:
    if not names:
        return F.lit(None).cast("string")
    return F.coalesce(*(F.col(f"`{name}`").cast("string") for name in names))
