"""Landing jobs: one source, one run date, to text-only Parquet."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ombuds.functions.names import rename_all
from ombuds.session import freeing_shuffles, path_exists, remove_path
from ombuds.sources.files import as_text, read_file
from ombuds.sources.jdbc import TableMissing, TableReader, read_table
from ombuds.sources.paths import AGENT_SHEET, Route, route

LANDED, SKIPPED, EMPTY = "landed", "skipped", "empty"
LOAD_TIME, DAY = "load_time", "dt"


@dataclass(frozen=True)
class Landing:
    """Outcome of one landing job. A source that is not there yet is skipped, not failed."""

    status: str
    path: str | None = None
    rows: int = 0


def stamp(df: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Add the load time as UTC text, the same for all rows."""
    return df.withColumn(LOAD_TIME, F.lit(f"{run_time:%Y-%m-%d %H:%M:%S}"))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def write_landed(df: DataFrame, root: str, chosen: Route) -> Landing:
    """Overwrite the source's folder, or only its day in it; counts rows while writing.

    The day's folder itself is written, so that a day landed again without rows is empty afterwards.
    """
    path = f"{root.rstrip('/')}/{chosen.target}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    with freeing_shuffles(df.sparkSession):
        counted.write.mode("overwrite").option("compression", "zstd").parquet(path if chosen.day is None else f"{path}/{DAY}={chosen.day}")
    return Landing(LANDED, path, seen.get["rows"])


def land(
    spark: SparkSession,
    lake: str,
    target: str,
    run_date: str,
    source: str,
    *,
    run_time: dt.datetime | None = None,
    table_reader: TableReader | None = None,
    sheet_file: str | None = None,
    multiline: bool | None = None,
) -> Landing:
    """Land one source. ``lake`` is the root of the source files, ``target`` the root of the landed ones."""
    chosen = route(run_date, source, sheet_file)
    style = "sheet" if source == AGENT_SHEET else "file"
    try:
        if chosen.kind == "jdbc":
            if table_reader is None:
                raise ValueError(f"{source} needs a table reader")
            df = rename_all(read_table(spark, chosen.source, table_reader), "jdbc")
        else:
            path = f"{lake.rstrip('/')}/{chosen.source}"
            if not path_exists(spark, path):
                return Landing(SKIPPED)
            df = read_file(spark, path, chosen.kind, style, multiline)
    except TableMissing:
        return Landing(SKIPPED)
    if df is None or (source == AGENT_SHEET and df.isEmpty()):
        if chosen.day is not None:
            remove_path(spark, f"{target.rstrip('/')}/{chosen.target}/{DAY}={chosen.day}")
        return Landing(EMPTY)
    return write_landed(stamp(as_text(df), run_time or utc_now()), target, chosen)
