"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order. Pivots are a bounded sample, every vector is indexed. The
inverted file of a pivot lists the vectors that have it among their first ``posts`` pivots. A query is sent to the files of
its own first ``probes`` pivots and nowhere else. A vector that lies in several of them is looked at in one: that of its
nearest pivot among those the query probes. There vectors are ranked by Spearman's footrule, which for lists of equal
length falls by twice ``length - max(place, place)`` for every pivot that both have, and the best ``share`` of a file, with
all ties, is ranked again by exact distance. Each file gives its nearest, and the nearest of all files are kept.

Files are cut into blocks by a hash of their vectors, and queries of a file into turns, so that a common pivot is many tasks'
work and no task holds more than a block; queries stream past it. Every vector is moved ``posts`` times, however many
there are (as long as a file has no more than a turn of queries). Of equal vectors only those of the smallest ids can be
among the nearest, so more of them than that are not indexed: this loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.llm.common import discard, ready, small_or_shuffled, written

#: Pivots (the bound of the sample), pivots that represent a vector, and the share of a file ranked exactly.
PIVOTS, NEAREST, SHARE = 256, 32, 0.45
#: Files that hold a vector, and files that a query is sent to.
POSTS, PROBES = 4, 64
#: Vectors for each pivot at least, as long as pivots are fewer than their bound.
FILE_ROWS = 64
BLOCK_ROWS, TURN_ROWS = 4096, 16384
#: Rows of a file that are ranked exactly at least, for each neighbour that is asked for.
LEAST_EACH = 10


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id, v`` without vectors that are null, empty, zero or hold nulls or non-finite numbers. Vectors of floats
    stay floats, half as wide; distances are taken in double precision."""
    single = vectors.schema[vector].dataType == T.ArrayType(T.FloatType(), vectors.schema[vector].dataType.containsNull)
    wide = F.col(f"`{vector}`").cast("array<float>" if single else "array<double>")
    plain = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), wide.alias("v")).where("vec_id is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return plain.where(finite & F.exists("v", lambda x: x != 0))


def pivots_of(plain: DataFrame, pivots: int) -> list[np.ndarray]:
    """At most ``pivots`` distinct vectors, chosen by hash, so that copies don't count."""
    hashed = plain.withColumn("h", F.xxhash64("v"))
    chosen = [row.h for row in hashed.select("h").distinct().orderBy("h").limit(pivots).collect()]
    rows = hashed.where(F.col("h").isin(chosen)).dropDuplicates(["h"]).orderBy("h").select("v").collect()
    return [np.array(row.v) for row in rows]


def _rows(column: pa.ListArray) -> list[np.ndarray]:
    """The vectors of a column, as views of one array."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[start:end] for start, end in zip(ends, ends[1:], strict=False)]


def _nearest(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, in order."""
    far = (pivots**2).sum(1)[None] - 2 * vectors @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :nearest]


class Index:
    """The inverted files of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, nearest: int):
        self.ids, self.vectors, self.pivots, self.nearest = ids, vectors, pivots, min(nearest, len(pivots))
        orders = _nearest(vectors, pivots, self.nearest)
        place = np.broadcast_to(np.arange(self.nearest), orders.shape).ravel()
        by_pivot = np.argsort(orders.ravel(), kind="stable")
        ends = np.searchsorted(orders.ravel()[by_pivot], np.arange(len(pivots) + 1))
        owner = by_pivot // max(1, self.nearest)
        self.files = [(owner[a:b], place[by_pivot[a:b]]) for a, b in zip(ends, ends[1:], strict=False)]

    def search(
        self,
        query: int,
        vector: np.ndarray,
        order: np.ndarray,
        k: int,
        share: float,
        least: int,
        here: np.ndarray | None = None,
    ):
        """The ``k`` nearest ids and distances among the candidates, the query's own row left out. ``here`` tells which
        rows are to be looked at in this file."""
        gain = np.zeros(len(self.ids), np.int64)
        for place, pivot in enumerate(order):
            owners, places = self.files[pivot]
            gain[owners] += self.nearest - np.maximum(places, place)
        near = np.flatnonzero((self.ids != query) if here is None else here & (self.ids != query))
        wanted = max(least, int(np.ceil(share * len(near))))
        if wanted < len(near):
            bar = np.partition(gain[near], len(near) - wanted)[len(near) - wanted]
            near = near[gain[near] >= bar]
        apart = self.vectors[near] - vector
        far = np.sqrt((apart * apart).sum(1))
        first = np.lexsort((self.ids[near], far))[:k]
        return self.ids[near][first], far[first]


def _posted(plain: DataFrame, sample: Broadcast, many: int) -> DataFrame:
    """``plain`` with ``posted``, the numbers of the first ``many`` pivots of each vector; -1 where none has its width."""
    kind = plain.schema["v"].dataType

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _rows(batch.column(1))
            widths, orders = np.array([len(v) for v in vectors], int), [[-1]] * len(vectors)
            for width in np.unique(widths):
                places, picked = np.flatnonzero(widths == width), _of_width(sample, width)
                if len(picked):
                    found = _nearest(np.array([vectors[i] for i in places], float), picked, many)
                    for place, order in zip(places, found.tolist(), strict=True):
                        orders[place] = order
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(orders, pa.list_(pa.int32()))], ["vec_id", "v", "posted"])

    fields = [T.StructField("vec_id", T.LongType()), T.StructField("v", kind), T.StructField("posted", T.ArrayType(T.IntegerType()))]
    return plain.select("vec_id", "v").mapInArrow(post, T.StructType(fields))


def _of_width(sample: Broadcast, width: int) -> np.ndarray:
    return np.array([p for p in sample.value if len(p) == width], float).reshape(-1, width)


_FILE = ["width", "pivot"]
_PLACE = [*_FILE, "block", "turn"]


def _in_files(posted: DataFrame) -> DataFrame:
    return posted.withColumn("width", F.size("v")).withColumn("pivot", F.explode("posted"))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    share: float = SHARE,
    least: int | None = None,
    block_rows: int = BLOCK_ROWS,
    posts: int = POSTS,
    probes: int = PROBES,
    turn_rows: int = TURN_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its ``k`` nearest rows of ``vectors`` found.

    Nearest first by Euclidean distance in double precision, ties to the smaller id; all of them if there are fewer.
    A row with the query's id is not a candidate. Rows without an id, and vectors that are null, empty, zero or hold
    nulls or non-finite numbers take no part; vectors of different lengths don't meet. Repeated rows are candidates
    each, and repeated query rows are one query. Equal vectors are candidates together or not at all. Empty tables
    give no rows, and other columns don't matter. How the rows are split into files or tasks doesn't matter either.
    """
    spark = vectors.sparkSession
    ready(spark)
    least = LEAST_EACH * k if least is None else least
    plain = usable(vectors, id, vector)
    # A vector can be nearest to its query by the ids of the first ``k`` equal ones, and one more if that is the query.
    equal = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    first = plain.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).drop("n")
    kept, kept_path = written(first, "vectors")
    asked = usable(queries, id, vector).dropDuplicates(["vec_id"])
    sample = spark.sparkContext.broadcast(pivots_of(kept, min(pivots, max(1, kept.count() // FILE_ROWS))))
    held, _ = written(_posted(kept, sample, posts), "postings")
    sought, _ = written(_posted(asked, sample, probes), "probes")
    discard(spark, kept_path)

    # A row per pivot and width: into how many blocks its file is cut, and its queries into how many turns.
    parts = _in_files(held.select("v", "posted")).groupBy(*_FILE).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    turns = _in_files(sought.select("v", "posted")).groupBy(*_FILE).agg(F.ceil(F.count("*") / turn_rows).cast("int").alias("turns"))
    files = small_or_shuffled(parts.join(turns, _FILE), "files", 32)
    mixed = F.xxhash64("vec_id", "v")
    columns = [*_PLACE, "asks", "vec_id", "v", "posted"]
    vectors_in = _in_files(held).join(files, _FILE).select(
        "*", F.pmod(mixed, F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")
    )
    queries_in = _in_files(sought).join(files, _FILE).select(
        "*", F.pmod(mixed, F.col("turns")).cast("int").alias("turn"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    both = vectors_in.withColumn("asks", F.lit(False)).select(columns).unionByName(
        queries_in.withColumn("asks", F.lit(True)).select(columns)
    )
    met = both.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "asks")

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block, index, earlier = None, [], None, None
        for batch in batches:
            ids, vectors, posted = batch.column(5).to_numpy(), _rows(batch.column(6)), batch.column(7).to_pylist()
            places = zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True)
            answers = []
            for here, asks, number, vector, order in zip(places, batch.column(4).to_pylist(), ids, vectors, posted, strict=True):
                if here != place:
                    place, block, index = here, [], None
                if not asks:
                    block.append((number, vector, order))
                    continue
                if not block:
                    continue
                picked = _of_width(sample, here[0]) if index is None else picked
                if index is None:
                    index = Index(np.array([x for x, _, _ in block]), np.array([x for _, x, _ in block], float), picked, nearest)
                    # The pivots of each vector before this file's: if a query probes one, it meets the vector there.
                    before = [x[: x.index(here[1])] for _, _, x in block]
                    earlier = np.array([x + [len(picked)] * (posts - len(x)) for x in before])
                probed = np.zeros(len(picked) + 1, bool)
                probed[[x for x in order if x >= 0]] = True
                found = index.search(
                    number, vector.astype(float), np.array(order[: index.nearest], int), k, share, least, ~probed[earlier].any(1)
                )
                answers.append((number, *found))
            if answers:
                counts = [len(near) for _, near, _ in answers]
                arrays = [np.repeat([n for n, _, _ in answers], counts)]
                arrays += [np.concatenate([x[i] for x in answers]) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["query_id", "vec_id", "score"])

    near = met.mapInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
