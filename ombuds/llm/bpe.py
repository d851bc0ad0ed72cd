"""BPE encoding and decoding by per-prefix dynamic programming (see ``bytebpe``)."""

from __future__ import annotations

from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ombuds.llm.bytebpe import encoder, vocabulary
from ombuds.llm.common import WordCache, ready, with_columns

ID = np.dtype("<i4")


@lru_cache(maxsize=4)
def packed_words(path: str) -> WordCache:
    """Packed ids by pre-token, kept for all tasks of a worker."""
    encode = encoder(path).encode
    return WordCache(lambda word: np.array(encode(word.encode()), ID).tobytes())


def packed_ids(text: str | None, path: str) -> bytes:
    """The ids of a whole text as little-endian 32-bit integers; special strings become their special ids."""
    known = packed_words(path)
    pieces = []
    for special, words in vocabulary(path).parts(text or ""):
        if special is not None:
            pieces.append(np.array([special], ID).tobytes())
        elif len(words) > 1:
            # Two steps: a full cache may start anew between the two, and a lookup then asks again.
            pieces.extend(map(known.__getitem__, words))
        elif words:
            pieces.append(known[words[0]])
    return b"".join(pieces)


def lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as an array column."""
    ends = np.cumsum([0, *(len(x) // ID.itemsize for x in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), ID)))


@lru_cache(maxsize=4)
def spelling(path: str) -> dict[int, bytes]:
    return vocabulary(path).bytes_of


def spelled(ids, path: str) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    if len(ids) < 2:
        return b"".join(spelling(path)[i] for i in ids).decode("utf-8", "replace")
    return b"".join(itemgetter(*ids)(spelling(path))).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text.

    Null and empty texts give no ids. Texts of any length are encoded whole; each row stands for itself, so ties and
    repeated rows are kept; an empty table stays empty. A column named ``ids`` is replaced, all others stay.
    """
    ready(docs.sparkSession)
    field = T.StructField(ids, T.ArrayType(T.IntegerType(), True), True)
    return with_columns(docs, text, [field], lambda: lambda texts: [lists([packed_ids(x, path) for x in texts])])


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids, special tokens written out.

    Null ids give null, no ids the empty text. An unknown id is an error. A column named ``text`` is replaced.
    """
    ready(encoded.sparkSession)
    field = T.StructField(text, T.StringType(), True)
    compute = lambda: lambda rows: [pa.array([None if x is None else spelled(x, path) for x in rows], pa.string())]
    return with_columns(encoded, ids, [field], compute)


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows, with the same results."""
    ready(docs.sparkSession)
    added = [
        T.StructField(ids, T.ArrayType(T.IntegerType(), True), True),
        T.StructField(decoded, T.StringType(), True),
    ]

    def both(texts: list[str | None]) -> list[pa.Array]:
        packed = [packed_ids(x, path) for x in texts]
        back = [spelled(np.frombuffer(x, ID).tolist(), path) for x in packed]
        return [lists(packed), pa.array(back, pa.string())]

    return with_columns(docs, text, added, lambda: both)
