"""Embedding whitening with MLlib's distributed block matrices.

Entries become whole numbers (1024ths, shifted), so counts, sums and squared deviations are exact. Centred rows are packed
into blocks of a ``BlockMatrix``; its transposed product with itself is the scatter, whose eigenvectors are found on the
driver (a square of the dimension); a second product with the whitening matrix projects the rows.

The transposed product of a tall matrix with itself has one block, which would be one task's work. So the factors' blocks
are dealt over ``GRID`` block rows of the left and ``GRID`` block columns of the right one: block ``(i, j)`` of the product
is the scatter of those row blocks that were dealt to ``i`` and ``j``, and the sum of all is the scatter. Each row block
meets itself only. The second product is laid out as a square of blocks for the same reason.

Vectors that are NULL or hold NULL, NaN or infinite entries are dropped. Vectors of another length than the commonest (the
longer, if two are) are dropped too, and so are empty ones. Entries count as at most 2^40 units from zero, so that no sum
overflows. Rows that repeat count and are returned each time; ids may be NULL or repeat. Directions in which the vectors
don't vary (an eigenvalue within rounding of 0) have no whitened value, so they are no components: equal vectors only, one
vector, or no rows give no rows. Of equal eigenvalues any basis is taken. A squared deviation beyond a long is NULL. Other
columns are left out, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.llm.common import ready, written

# Units of an entry, and the shift that makes most of them positive.
UNITS, SHIFT = 1024, 100_000
#: Entries count as so many units from zero at most.
MOST = float(1 << 40)
COMPONENTS = 8
#: Entries of a block; block rows and block columns that the scatter is summed in.
BLOCK_ENTRIES, GRID = 1 << 15, 8
#: Eigenvalues below this part of the largest are rounding errors.
ROUNDING = 1e-11


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(id, x)``: ids and whole-number vectors of the rows that take part."""
    entries = F.transform(F.col(f"`{vector_column}`"), lambda c: c.cast("double"))
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), entries.alias("entries"))
    odd = F.exists("entries", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("entries").isNotNull() & (F.size("entries") > 0)).where(~odd)

    def units(c):
        return F.floor(F.greatest(F.least(c * UNITS, F.lit(MOST)), F.lit(-MOST))).cast("long") + SHIFT

    rows = rows.select("id", F.transform("entries", units).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("rows"))
    commonest = sizes.orderBy(F.desc("rows"), F.desc("size")).first()
    return rows.where(F.size("x") == commonest["size"]) if commonest else rows


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum of each dimension."""
    places = rows.select(F.posexplode("x").alias("place", "x")).groupBy("place")
    found = places.agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total")).collect()
    return (found[0].n if found else 0), [int(row.total) for row in sorted(found, key=lambda row: row.place)]


def _away(x: np.ndarray, n: int, totals: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """``n * x - S`` and the sums of its squares (None beyond a long), both exact: in longs where they fit."""
    far = n * max(-int(x.min()), int(x.max()), 0) + max(map(abs, totals))
    kind = np.int64 if far < 1 << 62 else object
    away = n * x.astype(kind) - np.array(totals, kind)[None, :]
    most = max(-int(away.min()), int(away.max()))
    wide = away if most * most * x.shape[1] < 1 << 62 else away.astype(object)
    return away, [int(d) if d < 1 << 63 else None for d in (wide * wide).sum(axis=1)]


def _blocks(rows: DataFrame, n: int, totals: list[int]) -> DataFrame:
    """Centred rows as blocks ``(part, number, ids, deviations, centred)``, each full or filled up with rows of zeros,
    which add nothing to a scatter. Blocks of one task are numbered from 0."""
    dims = len(totals)
    height = max(1, BLOCK_ENTRIES // dims)
    schema = T.StructType().add("part", "integer").add("number", "integer").add("ids", T.ArrayType(rows.schema["id"].dataType))
    schema = schema.add("deviations", T.ArrayType(T.LongType())).add("centred", "binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, waiting = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays([ids for ids, _ in held])
            away, deviations = _away(np.concatenate([x for _, x in held]), n, totals)
            centred = np.zeros((height, dims), order="F")
            centred[: len(ids)] = away.astype(np.float64) / n
            columns = {
                "part": pa.array([part], pa.int32()),
                "number": pa.array([number], pa.int32()),
                "ids": pa.ListArray.from_arrays([0, len(ids)], ids),
                "deviations": pa.array([deviations], pa.list_(pa.int64())),
                "centred": pa.array([centred.tobytes(order="F")], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            ids, x = batch.column(0), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            at = 0
            while at < len(ids):
                some = min(len(ids) - at, height - waiting)
                held.append((ids.slice(at, some), x[at : at + some]))
                at, waiting = at + some, waiting + some
                if waiting == height:
                    yield block()
                    number, held, waiting = number + 1, [], 0
        if held:
            yield block()

    # Many small partitions would give as many blocks of mostly zeros.
    return rows.coalesce(-(-n // height)).mapInArrow(run, schema)


def _matrix(blocks, height: int, width: int, shape: tuple[int, int]) -> BlockMatrix:
    return BlockMatrix(blocks, height, width, shape[0] * height, shape[1] * width)


def scatter(blocks: DataFrame, height: int, dims: int, count: int) -> np.ndarray:
    """Sum over all rows of their products with themselves, from blocks ``(k, centred)``."""

    def left(row):
        block = DenseMatrix(dims, height, np.frombuffer(row.centred), True)
        return (row.k // GRID % GRID, row.k), block

    def right(row):
        return (row.k, row.k % GRID), DenseMatrix(height, dims, np.frombuffer(row.centred))

    found = blocks.select("k", "centred").rdd
    one = _matrix(found.map(left), dims, height, (GRID, count))
    two = _matrix(found.map(right), height, dims, (count, GRID))
    total = one.multiply(two).blocks.map(lambda block: block[1].toArray()).treeReduce(add)
    return (total + total.T) / 2


def project(blocks: DataFrame, height: int, dims: int, count: int, whitening: np.ndarray) -> DataFrame:
    """``(k, projected)``: every block times the whitening matrix, row by row as bytes."""
    side, wide = int(np.ceil(np.sqrt(count))), whitening.shape[1]
    spark = blocks.sparkSession

    def place(row):
        return (row.k // side, row.k % side), DenseMatrix(height, dims, np.frombuffer(row.centred))

    tall = _matrix(blocks.select("k", "centred").rdd.map(place), height, dims, (-(-count // side), side))
    values = whitening.flatten(order="F")
    copies = spark.sparkContext.range(side).map(lambda k: ((k, k), DenseMatrix(dims, wide, values)))
    product = tall.multiply(_matrix(copies, dims, wide, (side, side)))

    def back(block):
        (row, column), part = block
        return row * side + column, bytearray(np.ascontiguousarray(part.toArray()).tobytes())

    return spark.createDataFrame(product.blocks.map(back), "k long, projected binary")


def _unpacked(wide: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, deviations = batch.column(0)[at].values, batch.column(1)[at].values
                z = np.frombuffer(batch.column(2)[at].as_py())[: len(ids) * wide]
                lists = pa.ListArray.from_arrays(np.arange(0, len(z) + 1, wide, dtype=np.int32), pa.array(z))
                yield pa.RecordBatch.from_arrays([ids, deviations, lists], ["id", "deviation", "z"])

    return run


def identity_error(rows: DataFrame, wide: int) -> float:
    """Largest entry, by amount, of the covariance of ``z`` minus the identity; centred before multiplying."""
    means = rows.agg(*(F.avg(F.col("z")[i]).alias(f"m{i}") for i in range(wide))).first()
    from_mean = [F.col("z")[i] - means[i] for i in range(wide)]
    pairs = [(i, j) for i in range(wide) for j in range(i + 1)]
    found = rows.agg(*(F.avg(from_mean[i] * from_mean[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector that takes part and component: ``(id_column, component, n, deviation, whitened, explained,
    identity_error)``. Components are numbered from 1 by falling eigenvalue of the covariance of all vectors that take part."""
    spark = vectors.sparkSession
    ready(spark)
    kind = vectors.schema[id_column].dataType
    rows = usable(vectors, id_column, vector_column)
    n, totals = sums(rows)
    found = _whitened(rows, n, totals, components) if n else None
    if found is None:
        schema = T.StructType().add(id_column, kind).add("component", "integer").add("n", "long").add("deviation", "long")
        return spark.createDataFrame([], schema.add("whitened", "double").add("explained", "double").add("identity_error", "double"))
    z, explained = found
    error = identity_error(z, len(explained))
    return z.select("id", "deviation", F.posexplode("z").alias("place", "whitened")).select(
        F.col("id").alias(id_column),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*(F.lit(float(e)) for e in explained))[F.col("place")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def _whitened(rows: DataFrame, n: int, totals: list[int], components: int) -> tuple[DataFrame, np.ndarray] | None:
    """``(id, deviation, z)``, written, and the part of the variance that each component explains."""
    dims = len(totals)
    height = max(1, BLOCK_ENTRIES // dims)
    blocks, _ = written(_blocks(rows, n, totals), "blocks")
    # A number per task that made blocks; all blocks together are numbered without gaps.
    parts = sorted(blocks.groupBy("part").agg(F.count("*").alias("blocks")).collect())
    starts = np.cumsum([0, *(row.blocks for row in parts)]).tolist()
    count = starts.pop()
    offsets = blocks.sparkSession.createDataFrame(
        [(row.part, start) for row, start in zip(parts, starts)], "part int, start long"
    )
    blocks = blocks.join(F.broadcast(offsets), "part").withColumn("k", F.col("start") + F.col("number"))

    values, axes = np.linalg.eigh(scatter(blocks, height, dims, count) / n)
    values, axes = values[::-1], axes[:, ::-1]
    wide = int(min(components, (values > max(values[0], 0) * ROUNDING).sum()))
    if wide == 0:
        return None
    projected = project(blocks, height, dims, count, axes[:, :wide] / np.sqrt(values[:wide]))
    joined = blocks.select("k", "ids", "deviations").join(projected, "k").select("ids", "deviations", "projected")
    schema = T.StructType().add("id", rows.schema["id"].dataType).add("deviation", "long").add("z", T.ArrayType(T.DoubleType()))
    z, _ = written(joined.mapInArrow(_unpacked(wide), schema), "whitened")
    return z, values[:wide] / values.sum()
