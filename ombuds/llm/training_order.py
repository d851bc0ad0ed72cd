"""Token sequences in training order.

Texts become token ids, each text followed by the end token, cut into sequences of a fixed number of ids. A keyed
Feistel network permutes the numbers of all sequences: it is a bijection on the next square of a power of two, and
numbers that fall outside are sent through it again until they are inside (cycle walking), so every sequence gets a
global slot of its own without any table. Ranges of slots are shards, and each is one plain file: its records in the
order of slots, all of the same length, with nothing between them. So a slot's file and the place in it are arithmetic, and
training is resumed at any slot by seeking there and reading on.

Files are written by Spark's tasks and appear when their job commits, so a lost executor leaves no half shard. What a
record is made of (document, number of its sequence, tokens) stands in a small table beside the shards.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ombuds.llm.common import BATCH_ROWS, discard, ready, written
from ombuds.session import conf

LENGTH, SHARD_SLOTS, ROUNDS = 512, 16_384, 6
#: Jobs that write the shards, each a range of them. A job's shuffle is deleted at its end, so that not all records lie in
#: shuffle files beside the sequences and the shards.
WAVES = 3
ID = np.dtype("<u2")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """The slots of ``numbers`` below ``size``."""
    half = max(1, math.ceil(math.log2(max(2, size)) / 2))
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def mixed(value: np.ndarray, turn: int) -> np.ndarray:
        # Multiplication and shifts, with a constant of the key and the turn.
        secret = np.uint64((key * 0x9E37_79B9_7F4A_7C15 + (turn + 1) * 0xD1B5_4A32_D192_ED03) & (1 << 64) - 1)
        value = (value ^ secret) * np.uint64(0xBF58_476D_1CE4_E5B9)
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x94D0_49BB_1331_11EB)
        return (value ^ (value >> np.uint64(32))) & low

    def once(value: np.ndarray) -> np.ndarray:
        left, right = value >> shift, value & low
        for turn in range(ROUNDS):
            left, right = right, left ^ mixed(right, turn)
        return (left << shift) | right

    found = once(numbers.astype(np.uint64))
    outside = np.flatnonzero(found >= size)
    while len(outside):
        found[outside] = once(found[outside])
        outside = outside[found[outside] >= size]
    return found.astype(np.int64)


def sequences(docs: DataFrame, path: str, pattern: str, end: int, length: int) -> DataFrame:
    """``part, place, doc_id, seq_no, n_tokens, ids``: the sequences, numbered within each task."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place = encoding(path, pattern).encode_ordinary, TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for number, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                ids = np.array([*encode(text or ""), end], ID)
                rows += [(number, n, ids[at : at + length]) for n, at in enumerate(range(0, len(ids), length))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(rows), pa.int64()),
                    pa.array(range(place, place + len(rows)), pa.int64()),
                    pa.array([x for x, _, _ in rows], pa.int64()),
                    pa.array([x for _, x, _ in rows], pa.int32()),
                    pa.array([len(x) for _, _, x in rows], pa.int32()),
                    pa.array([x.tobytes() for _, _, x in rows], pa.binary()),
                ],
                ["part", "place", "doc_id", "seq_no", "n_tokens", "ids"],
            )
            place += len(rows)

    return docs.mapInArrow(cut, "part long, place long, doc_id long, seq_no int, n_tokens int, ids binary")


def materialise(
    docs: DataFrame,
    out: str,
    path: str,
    pattern: str,
    end: int,
    key: int = 1,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    shard_slots: int = SHARD_SLOTS,
) -> int:
    """Write all sequences of ``docs`` to shards under ``out`` and return how many there are.

    ``out/records`` gets a folder ``shard=<n>`` per range of ``shard_slots`` slots with one file: the record of slot ``s``
    begins at byte ``s % shard_slots * 2 * length``. A record has ``2 * length`` bytes: the ids as 16-bit numbers, then
    the end token as padding (behind the last record of a file the writer leaves a line feed). ``out/index`` has
    ``slot, doc_id, seq_no, n_tokens`` likewise. A task holds one shard's records at a time, ``shard_slots * 2 * length``
    bytes. Ids must be below 65536, or this fails. Null and empty texts are an end token alone; special strings in a text are ordinary text.
    Texts of any length are cut whole, repeated rows are each written, and a null id stays null. An empty table
    writes no shards. Sequences are numbered in the order of the rows read, so the same files, settings and key give
    the same slots.
    """
    spark = docs.sparkSession
    ready(spark)
    most = max(encoding(path, pattern).max_token_value, end)
    if most > np.iinfo(ID).max:
        raise ValueError(f"ids up to {most} don't fit the {ID.itemsize} bytes of an id")
    plain = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Written once: a task that runs again cannot number its sequences anew.
    cut, cut_path = written(sequences(plain, path, pattern, end, length), "sequences")
    sizes = {row.part: row.n for row in cut.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one per task
    total = sum(sizes.values())
    before, seen = {}, 0
    for part in sorted(sizes):
        before[part] = seen
        seen += sizes[part]
    starts = spark.sparkContext.broadcast(before)

    def placed(*names: str, low: int, high: int) -> DataFrame:
        """Columns ``names`` of the sequences of shards ``low`` to ``high - 1``, beside their places."""

        def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                first = np.array([starts.value[x] for x in batch.column(0).to_pylist()], np.int64)
                slot = permuted(first + batch.column(1).to_numpy(), total, key)
                shard = slot // shard_slots
                mine = np.flatnonzero((shard >= low) & (shard < high))
                columns = [pa.array(shard[mine]), pa.array(slot[mine]), *(x.take(pa.array(mine)) for x in batch.columns[2:])]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "slot", *names])

        found = cut.select("part", "place", *names)
        schema = ", ".join(["shard long", "slot long", *(f"{name} {found.schema[name].dataType.simpleString()}" for name in names)])
        # A partition per shard, in the order of slots. Slots are dense, so a shard is a range of known size and needs no sampling.
        by_shard = found.mapInArrow(place, schema).repartitionById(high - low, (F.col("shard") - low).cast("int"))
        return by_shard.sortWithinPartitions("shard", "slot")

    if total:
        count = -(-total // shard_slots)
        # All are made of the numbered sequences that are written above, so they agree whatever becomes of executors.
        with conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            about = placed("doc_id", "seq_no", "n_tokens", low=0, high=count)
            about.write.option("compression", "zstd").partitionBy("shard").parquet(f"{out}/index")
            step = -(-count // WAVES)
            for low in range(0, count, step):
                _write_files(placed("ids", low=low, high=min(count, low + step)), f"{out}/records", end, length)
        layout = spark.createDataFrame([(total, length, shard_slots)], LAYOUT)
        layout.coalesce(1).write.json(f"{out}/layout")
    discard(spark, cut_path)
    return total


LAYOUT = "total long, length int, shard_slots int"


def _write_files(ranged: DataFrame, out: str, end: int, length: int) -> None:
    """One file per shard, of its records in the order of slots."""

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padding, now, records = np.full(length, end, ID).tobytes(), None, []

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([b"".join(records)], pa.binary())], ["shard", "body"])

        for batch in batches:
            for shard, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if shard != now and records:
                    yield file()
                    records = []
                now = shard
                records.append(ids + padding[len(ids) :])
        if records:
            yield file()

    whole = ranged.mapInArrow(join, "shard long, body binary")
    # A text's bytes are written as they are, so this writes plain files of bytes.
    whole.select("shard", F.col("body").cast("string").alias("value")).write.mode("append").partitionBy("shard").text(out)


INDEX = "slot long, doc_id long, seq_no int, n_tokens int, shard long"


def index(spark: SparkSession, out: str) -> DataFrame:
    """``slot, doc_id, seq_no, n_tokens, shard``: what each record is made of."""
    return spark.read.schema(INDEX).parquet(f"{out}/index")


def layout(spark: SparkSession, out: str) -> Row:
    """``total, length, shard_slots`` of what was written."""
    return spark.read.schema(LAYOUT).json(f"{out}/layout").first()


def records(spark: SparkSession, out: str, first: int | None = None, count: int = 0) -> DataFrame:
    """``slot, shard, record``, cut out of the files at their places; with ``first`` only ``count`` slots from there on,
    from the files that hold them."""
    total, length, shard_slots = layout(spark, out)
    stride = ID.itemsize * length
    files = spark.read.format("binaryFile").load(f"{out}/records")
    low, high = (0, total) if first is None else (first, min(total, first + count))
    if first is not None:
        files = files.where(F.col("shard").cast("long").between(low // shard_slots, max(low, high - 1) // shard_slots))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                begin, end = max(low, shard * shard_slots), min(high, (shard + 1) * shard_slots)
                file = body.as_buffer()
                for at in range(begin, end, BATCH_ROWS):
                    slots = np.arange(at, min(end, at + BATCH_ROWS))
                    places = file.slice((at - shard * shard_slots) * stride, len(slots) * stride)
                    held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(stride), len(slots), [None, places])
                    columns = [pa.array(slots), pa.array(np.full(len(slots), shard)), held.cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["slot", "shard", "record"])

    return files.select(F.col("shard").cast("long"), "content").mapInArrow(cut, "slot long, shard long, record binary")


def shards(spark: SparkSession, out: str) -> DataFrame:
    """All records with what they are made of."""
    return index(spark, out).join(records(spark, out), ["slot", "shard"])


def resume(spark: SparkSession, out: str, slot: int, count: int, shard_slots: int | None = None) -> DataFrame:
    """The ``count`` records from ``slot`` on, in order. Only their shards are read, and of these only the places of
    the records become rows. ``shard_slots``, if given, must be what the shards were written with."""
    if shard_slots not in (None, layout(spark, out).shard_slots):
        raise ValueError(f"{out} wasn't written with {shard_slots} slots a shard")
    return records(spark, out, slot, count).orderBy("slot")


def read_ids(spark: SparkSession, out: str, slot: int, count: int) -> np.ndarray:
    """The ids of ``count`` records from ``slot`` on, a row each, for a trainer: a seek into each file that holds some of
    them, and one read of their bytes. Fewer rows at the end of the order."""
    _, length, shard_slots = layout(spark, out)
    stride, found = ID.itemsize * length, []
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while count > 0:
        shard, place = divmod(slot, shard_slots)
        wanted = min(count, shard_slots - place)
        name = jvm.org.apache.hadoop.fs.Path(f"{out}/records/shard={shard}/part-*")
        [*files] = name.getFileSystem(hadoop).globStatus(name) or []
        if not files:
            break
        held = min(wanted, files[0].getLen() // stride - place)
        if held > 0:
            stream = name.getFileSystem(hadoop).open(files[0].getPath())
            stream.seek(place * stride)
            found.append(np.frombuffer(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, held * stride), ID))
            stream.close()
        slot, count = slot + wanted, count - wanted
    return np.concatenate(found).reshape(-1, length) if found else np.empty((0, length), ID)
