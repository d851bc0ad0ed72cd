"""Scores by context-tree weighting.

The bytes of a text are coded bit by bit: a byte is eight binary decisions, each in the context of the bits before it
and of up to ``DEPTH`` bytes before the byte. Each node of the tree (a context of some depth and the first bits of a
byte) has a Krichevsky-Trofimov estimate from its counts of zeros and ones in the training texts, and a weight: the
probability that the node's own estimate, and not its children, made the counts, from their block probabilities. The
probability of a bit mixes the estimates along its path by the weights; the path ends at the deepest node that
training has seen.

The model is as large as the corpus makes it and is never in one place. Texts are packed into blocks; a block reports
each of its distinct strings of ``DEPTH + 1`` bytes once, with counts if it is for training. The strings are dealt by
the last ``ROOT`` bytes of their contexts, so every part holds whole subtrees, weighs them from the bottom up and finds
the probabilities of all strings reported. Above the subtrees there are at most 65,535 nodes; their counts and block
probabilities are added up and sent to all tasks. Words are counted and looked up in the same way.

Blocks and parts both grow with the corpus, so no block reports to all parts. Reports go through levels: at each, up to
``MERGED`` senders are added up to one bundle for a share of the parts, which deals its strings on to at most ``FAN``
finer shares. The answers go back the same way, each to those that asked and only for the strings they asked for. So
a level moves each sender's strings once, and there is a level more for each ``FAN`` times as much text.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ombuds.llm.common import discard, ready, written
from ombuds.session import conf

DEPTH, ROOT = 5, 2
BLOCK_BYTES = 6 << 20
#: Bytes of text for each part of the model, senders that are merged to one, and shares that one deals to.
PART_BYTES, MERGED, FAN = 32 << 20, 64, 64
SMOOTHING = 0.1
END = b"\n"

Node = tuple[np.ndarray, np.ndarray, np.ndarray]


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (of A to Z); the end that follows them is not listed."""
    return (text or "").encode().lower().split()


def packed(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``block, held, n_bytes, ids, body``: the words of many texts, each followed by a space, each text by its end,
    compressed. Training and held-out texts are in different blocks."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, tuple[list, list[bytes]]] = {False: ([], []), True: ([], [])}
        sizes = {False: 0, True: 0}

        def row(held: bool) -> pa.RecordBatch:
            ids, texts = waiting[held]
            body = b"".join(texts)
            columns = [
                pa.array([uuid.uuid4().hex]), pa.array([held]), pa.array([len(body)], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([zstandard.compress(body, 3)], pa.binary()),
            ]
            waiting[held], sizes[held] = ([], []), 0
            return pa.RecordBatch.from_arrays(columns, ["block", "held", "n_bytes", "ids", "body"])

        for batch in batches:
            for number, held, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                coded = b"".join(word + b" " for word in tokens(text)) + END
                waiting[held][0].append(number)
                waiting[held][1].append(coded)
                sizes[held] += len(coded)
                if sizes[held] >= block_bytes:
                    yield row(held)
        for held in waiting:
            if waiting[held][0]:
                yield row(held)

    return docs.mapInArrow(pack, "block string, held boolean, n_bytes long, ids array<long>, body binary")


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes: first bytes first, for neighbours in order differ in their last ones."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def spread(data: bytes, kind: type) -> np.ndarray:
    """The numbers that ``squeezed`` took."""
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def strings(body: bytes) -> np.ndarray:
    """For each byte its context of ``DEPTH`` bytes and itself, as one number. A text's context starts with ends."""
    # With an end for each byte of context before a text, no context reaches into the text before.
    padded = np.frombuffer(END * DEPTH + body.replace(END, END * DEPTH), np.uint8)
    size = len(padded) - DEPTH
    found = padded[:size].astype(np.int64)
    for ahead in range(1, DEPTH + 1):
        found <<= 8
        found |= padded[ahead : ahead + size]
    real = np.ones(size, bool)
    ends = np.flatnonzero(padded[DEPTH:] == END[0])
    real[ends[np.arange(len(ends)) % DEPTH > 0]] = False
    return found[real]


def _part(found: np.ndarray, parts: int) -> np.ndarray:
    context = (found >> 8) & ((1 << 8 * ROOT) - 1)
    return ((context * 2_654_435_761) >> 7) % parts


def _word_part(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(word) % parts for word in words), np.int64, len(words))


def levels(parts: int, n_blocks: int) -> list[int]:
    """For each level how many parts make one of its shares. The last has a share for each part and one bundle."""
    share, bundles, found = 1, _bundles(n_blocks), []
    while share * FAN < parts:
        share *= FAN
    while not found or found[-1] > 1 or bundles > 1:
        if found:
            share, bundles = max(1, share // FAN), _bundles(bundles)
        found.append(share)
    return found


def _bundles(senders: int) -> int:
    return max(1, -(-senders // MERGED))


def _words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b" ")


def _dealt(words: bool, keys, counts: np.ndarray, parts: int, share: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Number, keys and counts of each share, in the order of ``keys`` (strings as numbers, or a list of words)."""
    owner = (_word_part if words else _part)(keys, parts) // share
    for number in np.unique(owner).tolist():
        mine = np.flatnonzero(owner == number)
        if words:
            packed_keys = zstandard.compress(b" ".join(map(keys.__getitem__, mine.tolist())), 1)
        else:
            packed_keys = squeezed(keys[mine])
        yield number, packed_keys, squeezed(counts[mine])


def reports(blocks: DataFrame, parts: int, share: int, bundles: int) -> DataFrame:
    """``words, part, block, keys, counts, bundle``: what blocks report of strings and words to the first level."""

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held, body in zip(*(batch.column(x).to_pylist() for x in ("block", "held", "body")), strict=True):
                body = zstandard.decompress(body)
                found, counts = np.unique(strings(body), return_counts=True)
                seen = Counter(body.split())
                sizes = np.fromiter(seen.values(), np.uint32, len(seen))
                for words, keys, n in ((False, found, counts.astype(np.uint32)), (True, list(seen), sizes)):
                    rows = list(_dealt(words, keys, n * np.uint32(not held), parts, share))
                    columns = [
                        pa.array([words] * len(rows), pa.bool_()),
                        pa.array([x for x, _, _ in rows], pa.int32()),
                        pa.array([block] * len(rows), pa.string()),
                        pa.array([x for _, x, _ in rows], pa.binary()),
                        pa.array([x for _, _, x in rows], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["words", "part", "block", "keys", "counts"])

    found = blocks.select("block", "held", "body").mapInArrow(
        report, "words boolean, part int, block string, keys binary, counts binary"
    )
    return found.withColumn("bundle", F.pmod(F.xxhash64("block"), F.lit(bundles)).cast("long"))


def _added(rows: pd.DataFrame, kind: type) -> tuple:
    """Keys and added counts of several reports."""
    given = [spread(x, kind) for x in rows["counts"]]
    if not rows.words.iloc[0]:
        keys = np.concatenate([spread(x, np.int64) for x in rows["keys"]])
        found, place = np.unique(keys, return_inverse=True)
        return found, np.bincount(place, weights=np.concatenate(given), minlength=len(found)).astype(np.int64)
    sums: dict[bytes, int] = {}
    for keys, counts in zip(rows["keys"], given, strict=True):
        for word, n in zip(_words(keys), counts.tolist(), strict=True):
            sums[word] = sums.get(word, 0) + n
    return list(sums), np.fromiter(sums.values(), np.int64, len(sums))


def merged(asked: DataFrame, parts: int, share: int, kind: type) -> DataFrame:
    """What each bundle of a level reports to the next, whose shares are of ``share`` parts: ``words, part, bundle,
    from_part, from_bundle, keys, counts``. ``kind`` is that of the counts given."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        words, part, bundle = bool(rows.words.iloc[0]), int(rows.part.iloc[0]), int(rows.bundle.iloc[0])
        found = list(_dealt(words, *_added(rows, kind), parts, share))
        return pd.DataFrame(
            {
                "words": words,
                "part": [x for x, _, _ in found],
                "bundle": bundle // MERGED,
                "from_part": part,
                "from_bundle": bundle,
                "keys": [x for _, x, _ in found],
                "counts": [x for _, _, x in found],
            }
        )

    schema = "words boolean, part int, bundle long, from_part int, from_bundle long, keys binary, counts binary"
    given = asked.select("words", "part", "bundle", "keys", "counts")
    return given.groupBy("words", "part", "bundle").applyInPandas(add, schema)


def through_levels(blocks: DataFrame, parts: int, n_blocks: int) -> list[tuple[DataFrame, str]]:
    """What is reported to each level, written, and last the counts of each part."""
    shares = levels(parts, n_blocks)
    found = [written(reports(blocks, parts, shares[0], _bundles(n_blocks)), "reports")]
    for place, share in enumerate([*shares[1:], 1]):
        found.append(written(merged(found[-1][0], parts, share, np.int64 if place else np.uint32), "strings"))
    return found


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after a shift by eight."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return series - np.log(np.prod([x + i for i in range(8)], axis=0))


def log_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a block of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def estimate(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)


def weigh(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of a node's weighted probability, and the weight of its own estimate."""
    total = np.logaddexp(own, children) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


def _bit(found: np.ndarray, number: int) -> np.ndarray:
    return (found >> (7 - number)) & 1


def _nodes(found: np.ndarray, counts: np.ndarray, depth: int, number: int) -> Node:
    """Keys, zeros and ones of the nodes of one depth at one bit, from sorted strings of that depth."""
    key = found >> (8 - number)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ones = np.add.reduceat(counts * _bit(found, number), first)
    return key[first], np.add.reduceat(counts, first) - ones, ones


def _shorter(found: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings with contexts of ``depth`` bytes."""
    keys, place = np.unique(found & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
    return keys, np.bincount(place, weights=counts, minlength=len(keys))


def subtrees(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """For each string the probabilities of its eight bits from depth ``ROOT`` down, not a number where that depth
    has no node; and the sums that depth ``ROOT - 1`` needs, by bit: keys, zeros, ones, block probabilities."""
    wanted = found
    chances = np.full((len(wanted), 8), np.nan)
    trained = counts > 0
    found, counts = found[trained], counts[trained].astype(np.float64)
    if not len(found):
        return chances, {}
    levels = {DEPTH: (found, counts)}
    for depth in range(DEPTH - 1, ROOT - 2, -1):
        levels[depth] = _shorter(*levels[depth + 1], depth)
    sums = {}
    for number in range(8):
        child = None
        weighed = []
        for depth in range(DEPTH, ROOT - 1, -1):
            keys, zeros, ones = _nodes(*levels[depth], depth, number)
            own = log_block(zeros, ones)
            if child is None:
                total, weight = own, np.ones(len(keys))
            else:
                parent = np.searchsorted(keys, child[0] & ((1 << (8 * depth + number)) - 1))
                total, weight = weigh(own, np.bincount(parent, weights=child[1], minlength=len(keys)))
            weighed.append((depth, keys, zeros, ones, weight))
            child = keys, total
        bit = _bit(wanted, number)
        for depth, keys, zeros, ones, weight in weighed:
            key = (wanted & ((1 << 8 * (depth + 1)) - 1)) >> (8 - number)
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            here = keys[place] == key
            own, share, below = estimate(zeros[place], ones[place], bit), weight[place], chances[:, number]
            mixed = np.where(np.isnan(below), own, share * own + (1 - share) * np.nan_to_num(below))
            chances[:, number] = np.where(here, mixed, below)
        keys, zeros, ones = _nodes(*levels[ROOT - 1], ROOT - 1, number)
        parent = np.searchsorted(keys, child[0] & ((1 << (8 * (ROOT - 1) + number)) - 1))
        below = np.bincount(parent, weights=child[1], minlength=len(keys))
        sums[number] = np.stack([keys.astype(np.float64), zeros, ones, below])
    return chances, sums


class Top:
    """The nodes above the subtrees, of depths 0 and 1."""

    def __init__(self, rows: Iterable):
        self.levels: list[list[tuple]] = []
        by_bit: dict[int, list] = {}
        for row in rows:
            by_bit.setdefault(row["bit"], []).append((row["key"], row["zeros"], row["ones"], row["below"]))
        for number in range(8):
            table = np.array(sorted(by_bit.get(number, []))).reshape(-1, 4).T
            keys, zeros, ones, below = table[0].astype(np.int64), *table[1:]
            total, weight = weigh(log_block(zeros, ones), below)
            parent = keys & ((1 << number) - 1)
            above = np.unique(parent)
            place = np.searchsorted(above, parent)
            size = len(above)
            zeros0, ones0, below0 = (np.bincount(place, weights=x, minlength=size) for x in (zeros, ones, total))
            _, weight0 = weigh(log_block(zeros0, ones0), below0)
            self.levels.append([(keys, zeros, ones, weight), (above, zeros0, ones0, weight0)])

    def finish(self, wanted: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """Logarithms (base 10) of the probabilities of the strings' last bytes."""
        total = np.zeros(len(wanted))
        for number in range(8):
            bit, chance = _bit(wanted, number), chances[:, number]
            for depth, (keys, zeros, ones, weight) in zip((1, 0), self.levels[number], strict=True):
                if not len(keys):
                    continue
                key = (wanted & ((1 << 8 * (depth + 1)) - 1)) >> (8 - number)
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                own, share = estimate(zeros[place], ones[place], bit), weight[place]
                mixed = np.where(np.isnan(chance), own, share * own + (1 - share) * np.nan_to_num(chance))
                chance = np.where(keys[place] == key, mixed, chance)
            total += np.log10(np.where(np.isnan(chance), 0.5, chance))
        return total


def above(known: DataFrame) -> DataFrame:
    """``bit, key, zeros, ones, below``: what the nodes of depth ``ROOT - 1`` get from the subtrees of each part."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, sums = subtrees(spread(keys, np.int64), spread(counts, np.int64))
                for bit, table in sums.items():
                    columns = [pa.array([bit] * table.shape[1], pa.int32()), pa.array(table[0].astype(np.int64))]
                    columns += [pa.array(values) for values in table[1:]]
                    yield pa.RecordBatch.from_arrays(columns, ["bit", "key", "zeros", "ones", "below"])

    rows = known.where(~F.col("words")).select("keys", "counts")
    return rows.mapInArrow(build, "bit int, key long, zeros double, ones double, below double")


def finished(known: DataFrame, top: Broadcast) -> DataFrame:
    """``words, part, bundle, keys, values``: the logarithms of each part's strings, or the counts of its words."""

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, part, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not words:
                    found = spread(keys, np.int64)
                    chances, _ = subtrees(found, spread(counts, np.int64))
                    # Single precision holds a byte's logarithm to seven digits, a text's sum to more.
                    counts = squeezed(top.value.finish(found, chances).astype(np.float32))
                columns = [pa.array([words], pa.bool_()), pa.array([part], pa.int32()), pa.array([0], pa.int64())]
                columns += [pa.array([keys], pa.binary()), pa.array([counts], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["words", "part", "bundle", "keys", "values"])

    schema = "words boolean, part int, bundle long, keys binary, values binary"
    return known.select("words", "part", "keys", "counts").mapInArrow(finish, schema)


def answers(asked: DataFrame, solved: DataFrame) -> DataFrame:
    """The values of each report to a level, in its order, from those of the level's shares: ``words, part, block,
    values`` for blocks, else ``words, part, bundle, keys, values`` as the level before has them."""
    of_blocks = "block" in asked.columns
    names = {"part": "part", "block": "block"} if of_blocks else {"part": "from_part", "bundle": "from_bundle", "keys": "keys"}
    needed = list(dict.fromkeys(["words", "part", "bundle", "keys", *names.values()]))

    def answer(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        given: list[bytes] = []
        if len(rows) and rows.words.iloc[0]:
            counts: dict[bytes, int] = {}
            for keys, values in zip(table["keys"], table["values"], strict=True):
                counts.update(zip(_words(keys), spread(values, np.int64).tolist(), strict=True))
            for asks in rows["keys"]:
                words = _words(asks)
                given.append(squeezed(np.fromiter(map(counts.__getitem__, words), np.int64, len(words))))
        elif len(rows):
            everything = np.concatenate([spread(x, np.int64) for x in table["keys"]])
            values = np.concatenate([spread(x, np.float32) for x in table["values"]])
            if len(table) > 1:
                order = np.argsort(everything)
                everything, values = everything[order], values[order]
            for asks in rows["keys"]:
                given.append(squeezed(values[np.searchsorted(everything, spread(asks, np.int64))]))
        # An object column is one Arrow array, also where the rows came in several batches.
        passed = {name: pd.Series(rows[source].tolist(), dtype=object) for name, source in names.items()}
        return pd.DataFrame({"words": pd.Series(rows.words.tolist(), dtype=object), **passed, "values": given})

    kinds = {"part": "int", "block": "string", "bundle": "long", "keys": "binary"}
    schema = ", ".join(["words boolean", *(f"{name} {kinds[name]}" for name in names), "values binary"])
    by = ["words", "part", "bundle"]
    return asked.select(*needed).groupBy(*by).cogroup(solved.groupBy(*by)).applyInPandas(answer, schema)


def scored(
    blocks: DataFrame, given: DataFrame, parts: int, share: int, total: int, distinct: int, ends: int
) -> DataFrame:
    """The scores of the texts of each block."""
    floor = np.log10(total + SMOOTHING * (distinct + 1)) if total else np.log10(SMOOTHING)

    def score(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        body, ids, held = zstandard.decompress(rows.body.iloc[0]), rows.ids.iloc[0], bool(rows.held.iloc[0])
        by_part = dict(zip(zip(table.words, table.part, strict=True), table["values"], strict=True))
        place, found = pd.factorize(strings(body))
        order = np.argsort(found)
        found, logs = found[order], np.zeros(len(found))
        owner, sums = _part(found, parts) // share, np.zeros(len(found))
        for part in np.unique(owner).tolist():
            sums[owner == part] = spread(by_part[False, part], np.float32)
        logs[order] = sums
        values = np.frombuffer(body, np.uint8)
        last = np.flatnonzero(values == END[0])
        first = np.concatenate([[0], last[:-1] + 1])
        text_logs = np.add.reduceat(logs[place], first)

        words = body.split()
        number: dict[bytes, int] = {}
        each = np.fromiter((number.setdefault(word, len(number)) for word in words), np.int64, len(words))
        owner, counts = _word_part(list(number), parts) // share, np.zeros(len(number), np.int64)
        for part in np.unique(owner).tolist():
            counts[owner == part] = spread(by_part[True, part], np.int64)
        each = counts[each]
        # Running sums, so that texts without words need no case of their own.
        sizes = np.diff(np.concatenate([[0], np.cumsum(values == 32)[last]]))
        of = np.repeat(np.arange(len(sizes)), sizes)
        base = np.bincount(of, weights=np.log10(each + SMOOTHING) - floor, minlength=len(sizes))
        known = np.bincount(of, weights=each > 0, minlength=len(sizes)).astype(np.int64)
        n_bytes = last - first + 1
        return pd.DataFrame(
            {
                "id": pd.array([None if pd.isna(x) else int(x) for x in ids], dtype="Int64"),
                "held_out": held,
                "n_tokens": sizes + 1,
                "n_known": known + (ends > 0),
                "train_tokens": total,
                "base_score": base + np.log10(ends + SMOOTHING) - floor,
                "score": text_logs,
                "n_bytes": n_bytes,
                "bits_per_byte": -text_logs * np.log2(10) / n_bytes,
            }
        )

    schema = (
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double,"
        " n_bytes long, bits_per_byte double"
    )
    return blocks.groupBy("block").cogroup(given.groupBy("block")).applyInPandas(score, schema)


def score_texts(
    docs: DataFrame,
    held_out: Column,
    id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte`` for each row.

    The model learns from all texts for which ``held_out`` is false. A text is the sequence of its lower-cased words,
    each with a space, and its end; ``score`` is its log10 probability, ``bits_per_byte`` its code length per byte of
    that sequence. ``base_score`` is the smoothed unigram model over the same tokens. Null and empty texts are an end
    alone; a null ``held_out`` counts as false. Texts of any length are scored whole, repeated rows each for itself,
    and a null id stays null. Without training texts each bit has probability one half. An empty table gives no rows;
    other columns don't matter.
    """
    spark = docs.sparkSession
    ready(spark)
    # Rows hold whole blocks from here on. All that is lazy ends in the written scores.
    with conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="4"):
        return _score_texts(docs, held_out, id, text, block_bytes, part_bytes)


def _score_texts(docs, held_out, id, text, block_bytes, part_bytes) -> DataFrame:
    spark = docs.sparkSession
    plain = docs.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(f"`{text}`").alias("text")
    )
    with conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        blocks, at_blocks = written(packed(plain, block_bytes), "text-blocks")
    size = blocks.agg(F.sum("n_bytes"), F.count("*"), F.sum(F.when(~F.col("held"), F.size("ids")))).first()
    n_bytes, n_blocks, ends = (x or 0 for x in size)
    parts = max(1, -(-n_bytes // part_bytes))
    *asked, (known, at_known) = through_levels(blocks, parts, n_blocks)
    # 255 nodes for each byte before, and the bits before: 65,535 at most.
    sums = above(known).groupBy("bit", "key")
    top = sums.agg(*(F.sum(x).alias(x) for x in ("zeros", "ones", "below"))).collect()
    top = spark.sparkContext.broadcast(Top(row.asDict() for row in top))
    words, distinct = _word_totals(known.where("words"))
    total, distinct = words + ends, distinct + (ends > 0)
    given = finished(known, top)
    for level, _ in reversed(asked):
        given = answers(level, given)
    share = levels(parts, n_blocks)[0]
    found, _ = written(scored(blocks, given, parts, share, total, distinct, ends), "scores")
    discard(spark, at_blocks, at_known, *(path for _, path in asked))
    return found.withColumnRenamed("id", id)


def _word_totals(words: DataFrame) -> tuple[int, int]:
    """All words and distinct words in the training texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [spread(x, np.int64) for x in batch.column(0).to_pylist()]
            rows = [pa.array([int(x.sum()) for x in counts], pa.int64()), pa.array([int((x > 0).sum()) for x in counts], pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, ["n", "v"])

    found = words.select("counts").mapInArrow(count, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return found[0] or 0, found[1] or 0
