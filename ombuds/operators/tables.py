"""Versioned Parquet tables: full refresh by swap, and merge that rewrites only what a batch touches.

Parquet has no ``MERGE`` and no atomic replace, so every write goes to new folders and readers are repointed
afterwards. The pointer is itself a small dataset: one row per folder that a write made live or retired,
appended as one file once the data is complete and checked. Readers see the state before or after a write,
never between, and a failed write leaves nothing behind that is read.

One writer per table at a time, as with the merges this replaces.

Layout under ``root``: ``data/version=<n>/bucket=<b>/*.parquet`` and ``pointer/*.parquet``. A folder holds
the rows one write put into one hash bucket of the key, so it is also a slice of load time: a batch that
changes recent rows rewrites recent folders only, and new keys never force a rewrite of old ones.

Two small indexes are written beside each version. ``keys/`` has bitmaps of the hashed keys of every folder, some bits per
key: a merge compares them with those of its batch, and scans the keys of those folders only that share a bit. With a
``cluster`` column rows lie in order of its days, and ``days/`` has the first and last day of every file, so that
``read_between`` opens the files of a range only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.operators.dedup import latest_per_key
from ombuds.operators.quality import QualityError, duplicate_keys
from ombuds.operators.upsert import (
    BROADCAST_BYTES,
    ROW_BYTES,
    BatchSize,
    batch_size,
    measured,
    spread_keys,
    upsert,
    upsert_in_place,
    without_key,
)
from ombuds.schemas import AUDIT
from ombuds.session import freeing_shuffles, path_exists, remove_path, scratch

VERSION, BUCKET = "version", "bucket"
_SLICE = "_slice"
_PLACE = [T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
_POINTER = T.StructType(
    [
        T.StructField("written_by", T.LongType()),
        *_PLACE,
        T.StructField("live", T.BooleanType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("parts", T.IntegerType()),
        T.StructField("rows", T.LongType()),
    ]
)
_KEYS = T.StructType([*_PLACE, T.StructField("part", T.IntegerType()), T.StructField("bits", T.BinaryType())])
_DAYS = T.StructType(
    [
        *_PLACE,
        T.StructField("file", T.StringType()),
        T.StructField("first_day", T.DateType()),
        T.StructField("last_day", T.DateType()),
        T.StructField("rows", T.LongType()),
    ]
)
#: Bits of one bitmap, and of all bitmaps of a folder for each of its keys.
_BITS, _BITS_PER_KEY = 32768, 16
#: More than the bitmaps of a folder, and more than the buckets of a table: the base of their numbers.
_PARTS = 1 << 21
#: Rows of a file of a clustered table at most.
FILE_ROWS = 1_000_000
#: Bytes of a batch and the folders it changes that one task of a merge puts together.
TASK_BYTES = 128 * 1024 * 1024
#: Bytes that a merge shuffles at a time, until there are so many waves of buckets.
WAVE_BYTES, WAVES = 4 * TASK_BYTES, 8
#: Keys of a batch that are looked up first, to tell most of the folders it changes.
FIRST_KEYS = 10_000
#: Codec of stored rows. Keys are digests in hexadecimal, which codecs without entropy coding leave as long as they are.
CODEC = "zstd"

Folder = tuple[int, int]
Check = Callable[[DataFrame], None]


class VersionedTable:
    """A table split into ``buckets`` by the hash of ``key``, which no two rows share (unless it is NULL).

    Choose ``buckets`` so that one holds some tens of gigabytes. With ``buckets=1`` and no key the table is a
    plain snapshot that is always replaced whole.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str | None = None,
        buckets: int = 1,
        cluster: str | None = None,
        file_rows: int = FILE_ROWS,
    ):
        if buckets > 1 and key is None:
            raise ValueError("a table of several buckets needs a key")
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.buckets = key, buckets
        self.cluster, self.file_rows = cluster, file_rows

    # reading

    def read(self, at: int | None = None) -> DataFrame:
        """The current state, or that after write ``at``, as long as ``expire`` has left it."""
        return self._rows(self._live(at)[1])

    def written_by(self, version: int) -> DataFrame:
        """Rows of the folders that write ``version`` filled: all it inserted or changed, and their neighbours."""
        return self._rows([folder for folder in self._live(version)[1] if folder[0] == version])

    def read_between(self, first: dt.date, last: dt.date) -> DataFrame:
        """Rows whose cluster column lies from day ``first`` through day ``last``. Other files aren't opened."""
        if self.cluster is None:
            raise ValueError("read_between needs a cluster column")
        _, live, _ = self._live()
        if not live:
            return self._rows([])
        folders = self.spark.createDataFrame(live, T.StructType(_PLACE))
        days = self.spark.read.schema(_DAYS).parquet(f"{self.root}/days").join(folders, [VERSION, BUCKET], "left_semi")
        files = days.where((F.col("last_day") >= F.lit(first)) & (F.col("first_day") <= F.lit(last))).collect()
        paths = [f"{self.root}/data/{VERSION}={row[VERSION]}/{BUCKET}={row[BUCKET]}/{row.file}" for row in files]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self._rows([])
        kind = self.schema[self.cluster].dataType
        end = last + dt.timedelta(days=1)
        return rows.where((F.col(self.cluster) >= F.lit(first).cast(kind)) & (F.col(self.cluster) < F.lit(end).cast(kind)))

    def register(self, view: str) -> None:
        """Point a session view at the current state."""
        self.read().createOrReplaceTempView(view)

    def version(self) -> int:
        """Number of the last write; 0 before the first."""
        return self._live()[0]

    def counts(self) -> DataFrame:
        """``version, rows``: how many rows the table had after each write. Told by the pointer, where every write leaves
        the rows of its folders, so no data is read. NULL from a write on whose rows weren't counted."""
        if not path_exists(self.spark, f"{self.root}/pointer"):
            return self.spark.createDataFrame([], f"{VERSION} long, rows long")
        # A folder is written once, and made live or retired by later writes without being counted again.
        counted = F.max("rows").over(Window.partitionBy(VERSION, BUCKET))
        change = F.when(F.col("live"), F.col("counted")).otherwise(-F.col("counted"))
        per_write = self._pointer().withColumn("counted", counted).groupBy("written_by")
        per_write = per_write.agg(F.sum(change).alias("rows"), F.count_if(F.col("counted").isNull()).alias("unknown"))
        # A row per write by now.
        so_far = Window.orderBy("written_by").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        known = F.sum("unknown").over(so_far) == 0
        return per_write.select(F.col("written_by").alias(VERSION), F.when(known, F.sum("rows").over(so_far)).alias("rows"))

    def _pointer(self) -> DataFrame:
        return self.spark.read.schema(_POINTER).parquet(f"{self.root}/pointer")

    def revert(self, to: int) -> int:
        """Make the state after write ``to`` the current one again, as a write that moves no data."""
        last, live, _ = self._live()
        _, wanted, parts = self._live(to)
        back = [(last + 1, *folder, True, self.buckets, parts.get(folder), None) for folder in wanted if folder not in live]
        gone = [(last + 1, *folder, False, self.buckets, None, None) for folder in live if folder not in wanted]
        return self._point(last + 1, back + gone)

    def _live(self, at: int | None = None) -> tuple[int, list[Folder], dict[Folder, int]]:
        """Last version, the folders that make up the table (names only, never rows), and into how many parts the bitmaps
        of their keys are divided."""
        if not path_exists(self.spark, f"{self.root}/pointer"):
            return 0, [], {}
        pointer = self._pointer() if at is None else self._pointer().where(F.col("written_by") <= at)
        last = pointer.groupBy(VERSION, BUCKET).agg(
            F.max_by("live", "written_by").alias("live"),
            F.max("written_by").alias("written_by"),
            F.max("buckets").alias("buckets"),
            F.max("parts").alias("parts"),
        )
        rows = last.collect()
        if rows and rows[0].buckets != self.buckets:
            raise ValueError(f"{self.root} has {rows[0].buckets} buckets, not {self.buckets}")
        live = sorted((row[VERSION], row[BUCKET]) for row in rows if row.live)
        parts = {(row[VERSION], row[BUCKET]): row.parts for row in rows if row.live and row.parts}
        return max((row.written_by for row in rows), default=0), live, parts

    def _rows(self, folders: Iterable[Folder], with_place: bool = False) -> DataFrame:
        paths = [f"{self.root}/data/{VERSION}={v}/{BUCKET}={b}" for v, b in folders]
        schema = T.StructType([*self.schema.fields, *_PLACE]) if with_place else self.schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if with_place:
            reader = reader.option("basePath", f"{self.root}/data")
        return reader.parquet(*paths)

    # writing

    def replace(self, df: DataFrame, check: Check | None = None) -> int:
        """Full refresh: write everything anew, check it, then swap. Repeated keys are an error."""

        def check_all(written: DataFrame) -> None:
            if self.key is not None and not duplicate_keys(written, self.key).isEmpty():
                raise QualityError(f"{self.key} repeats in the new state of {self.root}")
            if check is not None:
                check(written)

        last, live, _ = self._live()
        with freeing_shuffles(self.spark):
            return self._publish(df, last + 1, retired=live, check=check_all)

    def merge(self, batch: DataFrame, update: tuple[str, ...] | None = None, order_by: str = AUDIT) -> int:
        """Deduplicate ``batch`` on the key, then insert new keys and update known ones."""
        if self.key is None:
            raise ValueError("merge needs a key")
        with freeing_shuffles(self.spark):
            return self._merge(batch, update, order_by)

    def _merge(self, batch: DataFrame, update: tuple[str, ...] | None, order_by: str) -> int:
        batch = batch.select(*self.schema.fieldNames())
        last, live, parts = self._live()
        # The first batch needs no look at its keys, and is deduplicated where it is written.
        staged, size, path = self._stage(latest_per_key(batch, self.key, order_by)) if live else self._sliced(batch)
        places = staged.select(BUCKET, _SLICE).distinct().collect()
        if not places:
            remove_path(self.spark, path)
            return last
        touched = {row[BUCKET] for row in places}
        near = self._may_hold(staged, [folder for folder in live if folder[1] in touched], parts) if live else []
        hit = []
        if near:
            hit = self._changed(staged.select(self.key).where(F.col(self.key).isNotNull()), size, near)
        waves = self._waves(staged, path, {row[_SLICE] for row in places}, size, hit)
        merged = (self._merged(*wave, size, update, order_by, not live) for wave in waves)
        first, keyless = next(merged)
        done = self._publish(first, last + 1, retired=hit, keyless=keyless, more=merged)
        remove_path(self.spark, path)
        return done

    def _waves(
        self, staged: DataFrame, path: str, filled: set[int], size: BatchSize, hit: list[Folder]
    ) -> Iterator[tuple[DataFrame, DataFrame, int, int, int]]:
        """A staged batch and the folders it changes, some buckets after others: so only what these shuffle is on disk at a time, and
        their part of the batch is deleted once the next is asked for. With them the first of the buckets, the end, and into how
        many tasks one is split."""
        total, slices = self._merge_bytes(size, hit), self._slices()
        waves = min(slices, max(1, -(-total // WAVE_BYTES)))
        parts = max(1, -(-total // (self.buckets * TASK_BYTES)))
        for wave in range(waves):
            mine = range(slices * wave // waves, slices * (wave + 1) // waves)
            if not filled.intersection(mine):
                continue
            low, high = (-(-end * self.buckets // slices) for end in (mine.start, mine.stop))
            source = staged.where(F.col(_SLICE).between(mine.start, mine.stop - 1)).drop(BUCKET, _SLICE)
            yield self._rows([folder for folder in hit if low <= folder[1] < high]), source, low, high, parts
            for number in mine:
                remove_path(self.spark, f"{path}/{_SLICE}={number}")

    def _merged(
        self,
        target: DataFrame,
        source: DataFrame,
        low: int,
        high: int,
        parts: int,
        size: BatchSize,
        update: tuple[str, ...] | None,
        order_by: str,
        new: bool,
    ) -> tuple[DataFrame, DataFrame | None]:
        """The rows of a wave, and beside those that lie bucket by bucket the ones without a key."""
        if new:
            return latest_per_key(source, self.key, order_by), None
        if size.rows_fit or self.buckets == 1:
            return upsert(target, source, self.key, update, size, unique_target=True), None
        place = (self._bucket_of() - low) * parts + F.pmod(F.xxhash64(self.key, F.lit("part")), F.lit(parts))
        merged = upsert_in_place(target, source, self.key, update, place, (high - low) * parts)
        return merged, without_key(target, source, self.key)

    def _changed(self, keys: DataFrame, size: BatchSize, folders: list[Folder]) -> list[Folder]:
        """Those folders that hold a key of the batch. Some keys, broadcast, tell most of them; the others are searched for all."""
        if size.keys_fit:
            return self._folders_with(spread_keys(keys, size), folders)
        first = self._folders_with(F.broadcast(keys.limit(FIRST_KEYS)), folders)
        rest = [folder for folder in folders if folder not in first]
        return sorted([*first, *(self._folders_with(keys, rest) if rest else [])])

    def _merge_bytes(self, size: BatchSize, hit: list[Folder]) -> int:
        """Bytes of a batch and of the folders it changes, by their rows and the texts of the batch."""
        rows = 0
        if hit:
            folders = self._pointer().where("live").groupBy(VERSION, BUCKET).agg(F.max("rows").alias("rows"))
            wanted = self.spark.createDataFrame(hit, T.StructType(_PLACE))
            rows = folders.join(F.broadcast(wanted), [VERSION, BUCKET]).agg(F.sum("rows")).first()[0] or 0
        return (size.rows + rows) * (ROW_BYTES + size.all_bytes // max(1, size.rows))

    def erase(self, values: DataFrame, column: str) -> int:
        """Delete the rows whose ``column`` is in the one-column frame ``values``."""
        with freeing_shuffles(self.spark):
            return self._erase(values, column)

    def _erase(self, values: DataFrame, column: str) -> int:
        wanted = values.toDF(column).where(F.col(column).isNotNull()).distinct()
        last, live, _ = self._live()
        size = wanted.agg(F.count("*").alias("rows"), F.sum(F.octet_length(F.col(column).cast("string"))).alias("bytes")).first()
        few = (size["bytes"] or 0) + size["rows"] * ROW_BYTES <= BROADCAST_BYTES
        wanted = F.broadcast(wanted) if few else wanted
        hit = self._folders_with(wanted, live)
        if not hit:
            return last
        kept = self._rows(hit).join(wanted, column, "left_anti")
        return self._publish(kept, last + 1, retired=hit, in_place=few)

    def _slices(self) -> int:
        """Into how many folders a staged batch is split, each with the rows of some buckets."""
        return min(self.buckets, WAVES)

    def _stage(self, latest: DataFrame) -> tuple[DataFrame, BatchSize, str]:
        """Write the deduplicated batch once: it is read three times, and a lost executor must not redo it."""
        return self._sliced(latest)

    def _sliced(self, batch: DataFrame) -> tuple[DataFrame, BatchSize, str]:
        """Write a batch in slices. Rows of one key are in one slice, and those without a key in the first."""
        path = scratch(self.spark, "staged")
        batch, seen = measured(batch, self.key)
        number = F.when(F.col(self.key).isNull(), 0).otherwise(F.expr(f"{BUCKET} * {self._slices()} div {self.buckets}"))
        batch = batch.withColumn(BUCKET, self._bucket_of()).withColumn(_SLICE, number.cast("int"))
        batch.write.option("compression", CODEC).partitionBy(_SLICE).parquet(path)
        schema = T.StructType([*self.schema.fields, *(T.StructField(name, T.IntegerType()) for name in (BUCKET, _SLICE))])
        return self.spark.read.schema(schema).parquet(path), batch_size(seen), path

    def _bits(self, rows: DataFrame, parts: Column) -> DataFrame:
        """``bucket, parts, part, bits``: bitmaps of the keys of ``rows``, whose hashes are dealt over ``parts``.

        Grouped by one number, since Spark sorts for this aggregate: one number by its digits, several columns by comparing."""
        hashed = F.xxhash64(self.key, F.lit("bitmap"))
        part = F.pmod(F.shiftrightunsigned(hashed, 20), parts)
        place = (F.col(BUCKET).cast("long") * _PARTS + parts) * _PARTS + part
        bit = hashed.bitwiseAND(F.lit(_BITS - 1)).alias("bit")
        places = rows.where(F.col(self.key).isNotNull()).select(place.alias("place"), bit)
        bits = places.groupBy("place").agg(F.bitmap_construct_agg("bit").alias("bits"))
        digit, rest = F.lit(_PARTS), F.expr(f"place div {_PARTS}")
        return bits.select(
            F.expr(f"place div {_PARTS * _PARTS}").cast("int").alias(BUCKET),
            (rest % digit).cast("int").alias("parts"),
            (F.col("place") % digit).cast("int").alias("part"),
            "bits",
        )

    def _may_hold(self, staged: DataFrame, folders: list[Folder], parts: dict[Folder, int]) -> list[Folder]:
        """Those folders whose bitmaps share a bit with the batch's, and those that have none. A folder that holds a key
        of the batch is always among them."""
        known = [(*folder, parts[folder]) for folder in folders if folder in parts]
        if not known:
            return folders
        sizes = F.array(*(F.lit(size) for size in sorted({size for *_, size in known})))
        batch = self._bits(staged.withColumn("parts", F.explode(sizes)), F.col("parts"))
        live = self.spark.createDataFrame(known, T.StructType([*_PLACE, T.StructField("parts", T.IntegerType())]))
        stored = self.spark.read.schema(_KEYS).parquet(f"{self.root}/keys").withColumnRenamed("bits", "stored")
        pairs = live.join(batch, [BUCKET, "parts"]).join(stored, [VERSION, BUCKET, "part"])
        both = pairs.select(VERSION, BUCKET, "part", F.explode(F.array("bits", "stored")).alias("bits"))
        shared = both.groupBy(VERSION, BUCKET, "part").agg(F.bitmap_and_agg("bits").alias("bits"))
        rows = shared.where(F.bitmap_count("bits") > 0).select(VERSION, BUCKET).distinct().collect()
        hits = {(row[VERSION], row[BUCKET]) for row in rows}
        return [folder for folder in folders if folder in hits or folder not in parts]

    def _folders_with(self, values: DataFrame, folders: list[Folder]) -> list[Folder]:
        """Those folders that hold a value of the one-column frame. Reads that column only."""
        [column] = values.columns
        target = self._rows(folders, with_place=True).select(column, VERSION, BUCKET)
        hits = target.join(values, column, "left_semi").select(VERSION, BUCKET).distinct()
        return sorted((row[VERSION], row[BUCKET]) for row in hits.collect())

    def _bucket_of(self) -> Column:
        """Bucket from the key alone, so a key never moves. NULL keys match nothing and are spread."""
        if self.buckets == 1:
            return F.lit(0)
        whole_row = F.xxhash64(*self.schema.fieldNames())
        hashed = F.when(F.col(self.key).isNull(), whole_row).otherwise(F.xxhash64(self.key))
        return F.pmod(hashed, F.lit(self.buckets)).cast("int")

    def _publish(
        self,
        df: DataFrame,
        version: int,
        retired: list[Folder],
        check: Check | None = None,
        keyless: DataFrame | None = None,
        in_place: bool = False,
        more: Iterable[tuple[DataFrame, DataFrame | None]] = (),
    ) -> int:
        """``keyless`` says that each task of ``df`` has rows of one bucket, and gives the rows without a key beside them.
        ``in_place`` says that ``df`` is a scan of folders of this table: a split holds rows of one bucket, and so there are no
        more files than splits without a shuffle. ``more`` such pairs of frames are written after the first, to the same version."""
        path = f"{self.root}/data/{VERSION}={version}"
        total = self._write(df, path, keyless, in_place, "overwrite")
        total += sum(self._write(rows, path, beside, in_place, "append") for rows, beside in more)
        filled = {0: total} if self.buckets == 1 else self._filled(path)
        written = [(version, bucket) for bucket in sorted(filled)]
        if check is not None:
            check(self._rows(written))
        parts = self._index(version, path, total // max(1, len(filled)) if written else 0)
        changes = [(version, *folder, True, self.buckets, parts, filled[folder[1]]) for folder in written]
        changes += [(version, *folder, False, self.buckets, None, None) for folder in retired]
        return self._point(version, changes)

    def _write(self, df: DataFrame, path: str, keyless: DataFrame | None, in_place: bool, mode: str) -> int:
        """Write rows of a version, and tell how many they are."""
        out = df.select(*self.schema.fieldNames())
        seen, rows = Observation(), F.count(F.lit(1)).alias("rows")
        if keyless is None:
            out = out.observe(seen, rows)
        day = [] if self.cluster is None else [F.to_date(self.cluster)]
        if self.buckets == 1:
            writer = (out.sortWithinPartitions(*day) if day else out).write
            path = f"{path}/{BUCKET}=0"
        else:
            # Rebalance keeps a bucket in few files, yet splits one that is too large for a task.
            out = out.withColumn(BUCKET, self._bucket_of())
            if keyless is None and not in_place:
                out = out.hint("rebalance", BUCKET)
            elif keyless is not None:
                spread = keyless.select(*self.schema.fieldNames()).withColumn(BUCKET, self._bucket_of()).hint("rebalance", BUCKET)
                out = out.unionByName(spread).observe(seen, rows)
            writer = (out.sortWithinPartitions(BUCKET, *day) if day else out).write.partitionBy(BUCKET)
        if day:
            # Sorted, and cut: each file holds few days, however the rows came to its task.
            writer = writer.option("maxRecordsPerFile", self.file_rows)
        writer.option("compression", CODEC).mode(mode).parquet(path)
        return seen.get["rows"]

    def _point(self, version: int, changes: list[tuple]) -> int:
        if not changes:
            return version - 1
        log = self.spark.createDataFrame(changes, _POINTER).coalesce(1)
        log.write.mode("append").parquet(f"{self.root}/pointer")
        return version

    def _index(self, version: int, path: str, folder_rows: int) -> int | None:
        """Write the indexes of a version, and tell into how many parts the bitmaps of its keys are divided."""
        names = [name for name in (self.key, self.cluster) if name is not None]
        schema = T.StructType([*(self.schema[name] for name in names), T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(path)
        if self.cluster is not None:
            day, file = F.to_date(self.cluster), F.col("_metadata.file_name").alias("file")
            days = rows.select(BUCKET, file, day.alias("day")).groupBy(BUCKET, "file")
            days = days.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("rows"))
            days.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/days/{VERSION}={version}")
        if self.buckets == 1:
            return None
        parts = min(_PARTS >> 1, 1 << (folder_rows * _BITS_PER_KEY // _BITS).bit_length())
        bits = self._bits(rows, F.lit(parts)).select(BUCKET, "part", "bits")
        bits.write.mode("overwrite").parquet(f"{self.root}/keys/{VERSION}={version}")
        return parts

    def _filled(self, path: str) -> dict[int, int]:
        """The rows of each bucket that a write filled. No column is read, so these are the counts of the files' footers."""
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(path).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows")).collect()
        return {row[BUCKET]: row["rows"] for row in rows}

    def expire(self, keep: int = 1) -> list[str]:
        """Delete folders retired before the last ``keep`` writes. Returns what was deleted."""
        last, _, _ = self._live()
        if not last:
            return []
        retired = self._pointer().where(~F.col("live") & (F.col("written_by") <= last - keep))
        rows = retired.select(VERSION, BUCKET).distinct().collect()
        jvm = self.spark.sparkContext._jvm
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        deleted = []
        for row in rows:
            name = f"{self.root}/data/{VERSION}={row[VERSION]}/{BUCKET}={row[BUCKET]}"
            path = jvm.org.apache.hadoop.fs.Path(name)
            if path.getFileSystem(hadoop).delete(path, True):
                deleted.append(name)
        return sorted(deleted)
