"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint has the majority bits of the hashes of its shingles. For each distinct fingerprint a table holds
its Hamming distances to reference fingerprints. One set of references lies in pairs that differ in a cell of two
bits only, so that a pair's two distances give the distance within the cell; the others lie far from each other.
By the triangle inequality two fingerprints within ``bits`` differ by at most ``bits`` in every distance, and by
nothing in all cells but those where they differ. So they agree in every cell distance of all but ``bits`` of eight
segments: fingerprints are posted under the cell distances of each choice of segments, which forms all pairs within
``bits`` and few others. Pairs whose largest difference to any far reference exceeds ``bits`` are discarded, and the
bits of the survivors are compared.

Only distinct fingerprints are paired, each has at most as many partners as there are fingerprints within ``bits``,
and components are formed from links between them, so groups of copies cost nothing but their count.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from ombuds.llm.common import keeps_names, ready, with_columns, written
from ombuds.llm.components import components

SEED = 42
SEGMENTS, CELLS_EACH = 8, 4
FAR_REFERENCES = 8


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits over the hashes of all word shingles, as a signed 64-bit integer; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    runs = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    count = len(words) - width + 1
    hashes = np.fromiter(map(xxh64_intdigest, runs, repeat(SEED)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for begin in range(0, count, 1 << 16):
        part = hashes[begin : begin + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of each whole text, as a long."""
    ready(docs.sparkSession)

    def compute() -> Callable[[list], list[pa.Array]]:
        return lambda texts: [pa.array([fingerprint(x, shingle) for x in texts], pa.int64())]

    return with_columns(docs, text, [T.StructField(out, T.LongType(), True)], compute)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def distance_table(found: DataFrame) -> DataFrame:
    """``fp`` with its distances: ``s0`` to ``s7``, the cell distances of each segment as a base-3 number, and
    ``far``, the distances to the far references, seven bits each."""
    fp = F.col("fp")
    base = F.xxhash64(F.lit("reference"))
    whole = found.select("fp", base.alias("base"), _distance(fp, base).alias("d"))

    def cell(number: int) -> Column:
        # The reference that differs from the base in this cell alone; with both distances, the one within the cell.
        mate = F.col("base").bitwiseXOR(F.shiftleft(F.lit(3).cast("long"), 2 * number))
        return ((F.col("d") - _distance(fp, mate) + 2) / 2).cast("long")

    segments = [
        sum((cell(s * CELLS_EACH + c) * 3**c for c in range(1, CELLS_EACH)), cell(s * CELLS_EACH)).alias(f"s{s}")
        for s in range(SEGMENTS)
    ]
    far = (F.shiftleft(_distance(fp, F.xxhash64(F.lit(i))).cast("long"), 7 * i) for i in range(FAR_REFERENCES))
    return whole.select("fp", *segments, reduce(Column.bitwiseOR, far).alias("far"))


def links(found: DataFrame, bits: int) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``fp`` that differ in at most ``bits`` bits, each once."""
    if not 0 <= bits <= SEGMENTS // 2:
        raise ValueError(f"a distance from 0 to {SEGMENTS // 2} bits is supported")
    choices = list(combinations(range(SEGMENTS), SEGMENTS - bits))
    size = 3 ** (CELLS_EACH * (SEGMENTS - bits))

    def key(number: int, chosen: tuple[int, ...]) -> Column:
        digits = (F.col(f"s{s}") * 3 ** (CELLS_EACH * place) for place, s in enumerate(chosen))
        return sum(digits, F.lit(number).cast("long") * size)

    post = F.explode(F.array(*(key(number, chosen) for number, chosen in enumerate(choices)))).alias("key")
    posted = distance_table(found).select("fp", "far", post)
    pairs = posted.select("key", F.col("fp").alias("a"), F.col("far").alias("far_a")).join(
        posted.select("key", F.col("fp").alias("b"), F.col("far").alias("far_b")), "key"
    )

    def coordinate(far: str, number: int) -> Column:
        return F.shiftright(F.col(far), 7 * number).bitwiseAND(F.lit(127))

    apart = [F.abs(coordinate("far_a", i) - coordinate("far_b", i)) for i in range(FAR_REFERENCES)]
    return (
        pairs.where(F.col("a") < F.col("b"))
        .where(F.greatest(*apart) <= bits)
        .where(_distance(F.col("a"), F.col("b")) <= bits)
        .select("a", "b")
        .distinct()
    )


def _grouped(printed: DataFrame, bits: int) -> DataFrame:
    """``fp, group, component_id`` for each fingerprint of ``printed(id, fp)``."""
    distinct = printed.groupBy("fp").agg(F.min("id").alias("least"))
    joined = components(links(distinct.select("fp"), bits))
    grouped = distinct.join(joined, distinct.fp == joined.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group")
    )
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    return grouped.select("fp", "group").join(least, "group")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id
    that links of at most ``bits`` differing bits lead to.

    Null and empty texts have fingerprint zero and are linked like any other; texts of any length count whole.
    Rows of a null id are grouped too, but give no smallest id: a group of such rows alone has a null
    ``component_id``. Repeated rows stay repeated. An empty table gives no rows; other columns don't matter.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    printed, _ = written(fingerprints(rows, "text", "fp", shingle).select("id", "fp"), "fingerprints")
    return printed.join(_grouped(printed, bits).select("fp", "component_id"), "fp").select(
        F.col("id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@keeps_names
def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, all its columns unchanged.

    Ties of the id are broken by a hash of the text; a null id comes last. Of repeated rows one stays. Which row stays
    is found on ids and hashes alone, each fingerprint first; only then are whole rows looked at, under keys of their
    own, so a group of very many copies never meets in one task.
    """
    names = ["__fp", "__id", "__mark"]
    body = F.col(f"`{text}`")
    printed, _ = written(fingerprints(docs, text, "__fp", shingle), "fingerprints")
    marked = printed.withColumn("__id", F.struct(F.col(f"`{id}`").isNull(), F.col(f"`{id}`")))
    marked = marked.withColumn("__mark", F.coalesce(F.xxhash64(body), F.lit(0)))
    least = marked.groupBy("__fp").agg(F.min(F.struct("__id", "__mark")).alias("x"))
    groups = _grouped(printed.select(F.col(f"`{id}`").alias("id"), F.col("__fp").alias("fp")), bits)
    groups = groups.select(F.col("fp").alias("__fp"), "group")
    winners = least.join(groups, "__fp").groupBy("group").agg(F.min(F.struct("x", "__fp")).alias("y"))
    winners = winners.select("y.__fp", "y.x.__id", "y.x.__mark")
    turn = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0)))
    kept = marked.join(winners, names).withColumn("__turn", turn).where(F.col("__turn") == 1)
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))
