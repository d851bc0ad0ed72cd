"""Token counts by two lookups on the map side.

Pre-tokens that are frequent in the table come with their lengths in a small broadcast table; all others are encoded
once per worker and kept in a cache. No pre-token is shuffled: to find the frequent ones each task reports only those
that reach ``share`` of its own pre-tokens, at most ``1 / share`` of them. Whatever is that frequent overall is so in
some task, and no more than ``1 / share`` pre-tokens can be, which bounds the broadcast table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.llm.bytebpe import alphabet, vocabulary
from ombuds.llm.common import WordCache, ready, with_columns
from ombuds.session import shared_dir

#: A pre-token is frequent from this share of all pre-tokens on, so there are at most 20,000.
SHARE = 1 / 20_000
#: Entries at which a task's counter is cut back. It only loses rare pre-tokens, which then are lookups in the cache.
COUNTER_MOST, COUNTER_KEEP = 400_000, 100_000


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", share: float = SHARE) -> dict[str, int]:
    """Number of tokens of each frequent pre-token, counted over all rows."""

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, total = vocabulary(path), Counter(), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for _, found in words.parts(value or ""):
                    total += len(found)
                    seen.update(found)
            if len(seen) > COUNTER_MOST:
                seen = Counter(dict(seen.most_common(COUNTER_KEEP)))
        often = [(word, n) for word, n in seen.items() if n >= share * total]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *(w for w, _ in often)], pa.string()), pa.array([total, *(n for _, n in often)], pa.int64())],
            ["word", "n"],
        )

    counted = docs.select(F.col(f"`{text}`").alias("word")).mapInArrow(local, "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).checkpoint()
    total = counted.where(F.col("word").isNull()).agg(F.sum("n")).first()[0] or 0
    # The share bounds what comes to the driver, for the counts of all pre-tokens add up to the total.
    often = counted.where(F.col("word").isNotNull() & (F.col("n") >= F.lit(share * total))).select("word").collect()
    lengths = lengths_of(path)
    return {row.word: lengths[row.word] for row in often}


@lru_cache(maxsize=4)
def lengths_of(path: str) -> WordCache:
    """Number of tokens by pre-token, kept for all tasks of a worker. The library's own model encodes the misses."""
    model, stands = vocabulary(path).library.model, alphabet()
    return WordCache(lambda word: len(model.tokenize("".join(map(stands.__getitem__, word.encode())))))


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens", share: float = SHARE
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text; special strings in a text are one token each.

    Null and empty texts have none. Each row stands for itself, so ties and repeated rows are kept, and an empty
    table stays empty. A column named ``n_tokens`` is replaced, all others stay.
    """
    spark = docs.sparkSession
    ready(spark)
    shared_dir(spark)
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, path, text, share))

    def compute():
        words, rare, often = vocabulary(path), lengths_of(path), frequent.value

        def count(value: str | None) -> int:
            total = 0
            for special, found in words.parts(value or ""):
                total += special is not None
                known = list(map(often.get, found))
                if None in known:
                    total += sum(rare[word] if n is None else n for word, n in zip(found, known, strict=True))
                else:
                    total += sum(known)
            return total

        return lambda texts: [pa.array(map(count, texts), pa.int64())]

    return with_columns(docs, text, [T.StructField(n_tokens, T.LongType(), True)], compute)
