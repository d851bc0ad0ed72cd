"""The daily load as a file stream: every landed file is picked up once, checked, and merged.

The stream lists files; each micro-batch reads its own as the daily load does, so types and spellings may differ from file to
file, and a damaged file is left out. Such files are kept in a quarantine list beside the table and tried again once they
have changed, as a stream looks at a path only once.

Every micro-batch is one entry in a list of batches with the time its rows are stamped with. A batch that is run again after a
failure takes the time it had, and merging the same rows twice changes nothing; one that was finished is passed over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.operators.tables import VersionedTable
from ombuds.plans.marts import fct_unified_complaints
from ombuds.plans.pipeline import fill_audit
from ombuds.plans.staging import STAGING
from ombuds.schemas import AUDIT, RAW_TABLES, RawTable
from ombuds.session import path_exists
from ombuds.sources.landing import utc_now
from ombuds.sources.stage import empty_files, list_files, stage_files

_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_BATCH = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("run_time", T.TimestampNTZType()),
        T.StructField("done", T.BooleanType()),
    ]
)
_HELD = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("damaged", T.BooleanType()),
        T.StructField("noted_at", T.TimestampNTZType()),
    ]
)


def read_landed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the paths of landed files. Contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(_FILE)
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(folder).select("path")


def quarantined(spark: SparkSession, target: VersionedTable) -> DataFrame:
    """``(path, length, modified)`` of files that were damaged when they were last read."""
    path = f"{target.root}/quarantine"
    noted = spark.read.schema(_HELD).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], _HELD)
    last = noted.groupBy("path").agg(F.max_by(F.struct("length", "modified", "damaged"), "noted_at").alias("last"))
    return last.where("last.damaged").select("path", "last.length", "last.modified")


def load_available(
    spark: SparkSession,
    table: RawTable,
    folder: str,
    target: VersionedTable,
    checkpoint: str,
    run_time: dt.datetime | None = None,
    fact: VersionedTable | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Merge everything that arrived since the last call, then stop. Returns the number of batches merged.

    With ``fact`` the changed rows also go to the unified fact.
    """
    merged = 0

    def load(paths: Sequence[str], now: dt.datetime) -> set[str]:
        """Merge files; returns the damaged ones."""
        staged = stage_files(spark, table, list(paths))
        _note(spark, target, folder, set(staged.rejected), damaged=True)
        if len(staged.rejected) < len(paths):
            version = target.merge(fill_audit(staged.rows, now), table.update)
            if fact is not None:
                # What the merge made of the batch, not the batch: a partial merge keeps old columns.
                changed = target.written_by(version).where(F.col(AUDIT) >= F.lit(now).cast("timestamp_ntz"))
                fact.merge(_complaints_of(table, changed), order_by="ingested_at")
        staged.discard()
        return set(staged.rejected)

    def merge(batch: DataFrame, number: int) -> None:
        nonlocal merged
        now, done = _begin(spark, target, number, run_time or utc_now())
        if done:
            return
        load([row.path for row in batch.collect()], now)
        _write(spark, [(number, now, True)], _BATCH, f"{target.root}/batches")
        merged += 1

    again = _changed_since(spark, target, folder)
    if again:
        damaged = load(again, run_time or utc_now())
        _note(spark, target, folder, set(again) - damaged, damaged=False)
        merged += 1
    _note_empty(spark, target, folder)
    stream = read_landed(spark, folder, files_per_batch)
    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return merged


def _write(spark: SparkSession, rows: list[tuple], schema: T.StructType, path: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _begin(spark: SparkSession, target: VersionedTable, number: int, now: dt.datetime) -> tuple[dt.datetime, bool]:
    """The time of a batch, the one it was first given, and whether it was finished."""
    path = f"{target.root}/batches"
    if path_exists(spark, path):
        noted = spark.read.schema(_BATCH).parquet(path).where(F.col("batch") == number)
        known = noted.agg(F.min("run_time").alias("run_time"), F.bool_or("done").alias("done")).first()
        if known.run_time is not None:
            return known.run_time, known.done
    _write(spark, [(number, now, False)], _BATCH, path)
    return now, False


def _note(spark: SparkSession, target: VersionedTable, folder: str, paths: set[str], damaged: bool) -> None:
    """Put files into the quarantine list as they are now, damaged or put right."""
    if not paths:
        return
    wanted = spark.createDataFrame([(path,) for path in paths], "path string")
    files = list_files(spark, folder).join(wanted, "path", "left_semi")
    noted = F.lit(utc_now()).cast("timestamp_ntz").alias("noted_at")
    entries = files.select("path", "length", "modified", F.lit(damaged).alias("damaged"), noted)
    entries.coalesce(1).write.mode("append").parquet(f"{target.root}/quarantine")


def _note_empty(spark: SparkSession, target: VersionedTable, folder: str) -> None:
    """Files of no bytes go to the quarantine list too: the stream takes them for read, and no scan has them."""
    new = set(empty_files(spark, folder))
    new -= {row.path for row in quarantined(spark, target).select("path").collect()} if new else set()
    if new:
        rows = [(path, 0, dt.datetime(1970, 1, 1), True, utc_now()) for path in sorted(new)]
        _write(spark, rows, _HELD, f"{target.root}/quarantine")


def _changed_since(spark: SparkSession, target: VersionedTable, folder: str) -> list[str]:
    """Damaged files that are no longer what they were when they were read."""
    if not path_exists(spark, f"{target.root}/quarantine"):
        return []
    held = quarantined(spark, target).withColumnsRenamed({"length": "old_length", "modified": "old_modified"})
    files = list_files(spark, folder).join(held, "path")
    changed = files.where("length <> old_length or modified <> old_modified")
    return sorted(row.path for row in changed.select("path").collect())


def _complaints_of(table: RawTable, rows: DataFrame) -> DataFrame:
    """Unified-fact rows of one channel; the other two channels take part as empty frames."""
    staged = {}
    for name in ("call_center_logs", "web_complaints", "social_media"):
        raw = rows if name == table.name else rows.sparkSession.createDataFrame([], RAW_TABLES[name].schema)
        view, build = STAGING[name]
        staged[view] = build(raw)
    return fct_unified_complaints(**staged)
