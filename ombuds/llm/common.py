"""What several of the operators need: bounded Arrow batches, written tables, caches of a bounded size."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.session import path_exists, scratch

#: Rows that Python gets at a time. Texts can be long, so it is far below Spark's default.
BATCH_ROWS = 1000
#: Entries that a worker's cache holds, and characters of a word that is kept at most.
CACHE_ENTRIES, CACHED_CHARS = 300_000, 64


def ready(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Make a session fit for the operators that use Python: workers get at most ``rows`` rows at a time, and can
    import this library wherever they run. Results don't depend on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= rows:
        spark.conf.set(key, str(rows))
    if spark.sparkContext.applicationId not in _shipped:
        _ship(spark)
        _shipped.add(spark.sparkContext.applicationId)


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send the library's sources to the workers by way of the shared folder."""
    root = Path(__file__).resolve().parents[1]
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    target = f"{scratch(spark, 'library')}/{root.name}.zip"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(archive.getvalue())
    out.close()
    spark.sparkContext.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read again, and its path: lineage ends here, and a lost executor
    costs nothing that is written."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        if path_exists(spark, path):
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as make it no column of ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keeps_names(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions of a frame whose inner columns begin with two underscores: columns of the frame that do so too have
    other names meanwhile, and their own again in the result."""

    @functools.wraps(work)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        inner = [name for name in df.columns if name.startswith("__")]
        if not inner:
            return work(df, *args, **kwargs)
        stem = "own"
        while any(name.lower().startswith(stem) for name in df.columns):
            stem += "_"
        away = {name: f"{stem}_{number}" for number, name in enumerate(inner)}
        moved = {name: away.get(value, value) if isinstance(value, str) else value for name, value in kwargs.items()}
        positional = [away.get(value, value) if isinstance(value, str) else value for value in args]
        back = {new: old for old, new in away.items()}
        return work(df.withColumnsRenamed(away), *positional, **moved).withColumnsRenamed(back)

    return run


def with_columns(
    df: DataFrame,
    source: str,
    added: list[T.StructField],
    compute: Callable[[], Callable[[list], list[pa.Array]]],
) -> DataFrame:
    """``df`` with columns that Python computes from column ``source``, a batch at a time.

    ``compute()`` is called once per task and gives the function from the values of a batch to the new columns.
    Columns of the same names are replaced; all others pass through unchanged, whatever their type.
    """
    names = {field.name for field in added}
    passed = [field for field in df.schema.fields if field.name not in names]
    feed = "__source"
    while feed in df.columns or feed in names:
        feed += "_"
    # The source is handed over under a name of its own, so that it may be one of the replaced columns.
    fed = df.select(*(F.col(f"`{field.name}`") for field in passed), F.col(f"`{source}`").alias(feed))
    kept = [field.name for field in passed]
    types = {field.name: field for field in added}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = compute()
        for batch in batches:
            columns = work(batch.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *columns], [*kept, *types])

    return fed.mapInArrow(run, T.StructType([*passed, *added]))


class Cache(dict):
    """Answers of ``ask`` by key, bounded: a full cache becomes the old one, and what is asked for again moves over
    from there, so what is in use stays. Holds ``2 * most`` entries at most."""

    def __init__(self, ask: Callable, most: int = CACHE_ENTRIES):
        super().__init__()
        self.ask, self.most, self.old = ask, most, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.ask(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class WordCache(Cache):
    """A cache by word whose bytes are bounded too: a word of more than ``CACHED_CHARS`` characters (an encoded file, a run
    of digits) is asked for each time and not kept."""

    def __missing__(self, word: str):
        return self.ask(word) if len(word) > CACHED_CHARS else super().__missing__(word)


#: Bytes of a table that is broadcast at most; a larger one is joined by shuffling.
BROADCAST_BYTES = 32 << 20


def small_or_shuffled(df: DataFrame, label: str, row_bytes: int | Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, written, and marked for broadcast if its rows of ``row_bytes`` come to ``most`` at most: a number where all
    are of one size, else a column, which is summed."""
    kept, _ = written(df, label)
    size = F.sum(row_bytes) if isinstance(row_bytes, Column) else F.count("*") * row_bytes
    return F.broadcast(kept) if (kept.agg(size).first()[0] or 0) <= most else kept
