"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are its own and those of the lines before and after it; neighbouring
labels depend on each other by four transition weights. The lines of a labelled document all carry its label. The
weights maximise the penalised likelihood: each evaluation of it and of its gradient is a Spark job that returns one
row per partition, and L-BFGS on the driver sees sums only. A document's score is the mean of its lines' marginal
probabilities of being good, from the forward-backward recursions, weighted by the lines' lengths.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ombuds.llm.common import discard, ready, with_columns, written

#: Labelled documents that a model learns from at most, chosen by a hash of their ids.
FIT_DOCUMENTS = 20_000
PENALTY, ROUNDS = 1e-3, 40
OWN = 12
#: Own features of a line and of its two neighbours, whether these are there, and a constant.
FEATURES = 3 * OWN + 3

_SYMBOLS = b"#$%&*!@^~=+<>|_\\/{}[]"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_STOPS = b".,;:?"


def own_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of the lines of a text."""
    lines = text.split("\n")
    again = Counter(lines) if len(lines) > 1 else {}
    n_words = 0
    rows, lengths = [], []
    for line in lines:
        raw, words = line.encode(), line.split()
        count, size = len(words), max(1, len(raw))
        n_words += count
        one = max(1, count)
        rows.append(
            (
                math.log1p(count) / 5,
                math.log1p(len(raw)) / 10,
                raw.count(b"|") / one,
                sum(map(eq, words, words[1:])) / one,
                len(set(words)) / one,
                1 - len(raw.translate(None, _SYMBOLS)) / size,
                1 - len(raw.translate(None, _UPPER)) / size,
                1 - len(raw.translate(None, _DIGITS)) / size,
                1 - len(raw.translate(None, _STOPS)) / size,
                sum(len(word) < 4 for word in words) / one,
                float(again.get(line, 1) > 1),
                0.0,
            )
        )
        lengths.append(max(1, len(line)))
    found = np.array(rows, np.float32)
    found[:, OWN - 1] = math.log1p(n_words) / 10
    return found, np.array(lengths, np.float64)


def with_neighbours(own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The features of lines whose documents have ``sizes`` lines, one after another."""
    total = len(own)
    ends = np.cumsum(sizes)
    first, last = np.zeros(total, bool), np.zeros(total, bool)
    first[ends - sizes], last[ends - 1] = True, True
    found = np.zeros((total, FEATURES))
    found[:, :OWN] = own
    found[1:, OWN : 2 * OWN] = own[:-1]
    found[:-1, 2 * OWN : 3 * OWN] = own[1:]
    found[first, OWN : 2 * OWN] = 0
    found[last, 2 * OWN : 3 * OWN] = 0
    found[:, 3 * OWN], found[:, 3 * OWN + 1], found[:, 3 * OWN + 2] = first, last, 1
    return found


def forward_backward(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For chains one after another: log probabilities ``[line, label]``, ``[line, label before, label]`` (zero for
    first lines, not a logarithm), and each chain's log normaliser. ``scores`` are those of label 1; label 0 has 0."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    node = np.stack([np.zeros(len(scores)), scores], 1)
    ahead, behind = node.copy(), np.zeros((len(scores), 2))
    steps = int(ordered[0]) if len(ordered) else 0
    active = [int(np.searchsorted(-ordered, -step, side="left")) for step in range(steps)]  # chains longer than step
    for step in range(1, steps):
        at = starts[: active[step]] + step
        ahead[at] += np.logaddexp(ahead[at - 1, :1] + moves[0], ahead[at - 1, 1:] + moves[1])
    for step in range(steps - 1, 0, -1):
        at = starts[: active[step]] + step
        after = node[at] + behind[at]
        behind[at - 1] = np.logaddexp(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
    ends = np.cumsum(sizes) - 1
    normal = np.logaddexp(ahead[ends, 0], ahead[ends, 1])
    of = np.repeat(normal, sizes)
    single = ahead + behind - of[:, None]
    pairs = np.zeros((len(scores), 2, 2))
    inner = np.ones(len(scores), bool)
    inner[ends - sizes + 1] = False
    at = np.flatnonzero(inner)
    pairs[at] = np.exp(
        ahead[at - 1][:, :, None] + moves[None] + (node[at] + behind[at])[:, None, :] - of[at][:, None, None]
    )
    return single, pairs, normal


def likelihood(weights: np.ndarray, own: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood, each document divided by its lines, and its gradient."""
    features, moves = with_neighbours(own, sizes), weights[FEATURES:].reshape(2, 2)
    single, pairs, normal = forward_backward(features @ weights[:FEATURES], moves, sizes)
    of, share = np.repeat(labels, sizes), np.repeat(1 / sizes, sizes)
    scores = np.add.reduceat(features @ weights[:FEATURES] * of, np.cumsum(sizes) - sizes)
    kept = scores + (sizes - 1) * moves[labels, labels]
    loss = float(((normal - kept) / sizes).sum())
    by_feature = features.T @ ((np.exp(single[:, 1]) - of) * share)
    by_move = (pairs * share[:, None, None]).sum(0)
    for label in (0, 1):
        mine = labels == label
        by_move[label, label] -= ((sizes[mine] - 1) / sizes[mine]).sum()
    return loss, np.concatenate([by_feature, by_move.ravel()])


def lbfgs(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int) -> np.ndarray:
    """Minimises with a memory of ten steps and halved steps."""
    point, (value, slope) = start, evaluate(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, parts = slope.copy(), []
        for move, change in reversed(moves):
            part = move @ way / (move @ change)
            parts.append(part)
            way -= part * change
        if moves:
            way *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1])
        for (move, change), part in zip(moves, reversed(parts), strict=True):
            way += move * (part - change @ way / (move @ change))
        length = 1.0 if moves else min(1.0, 1 / max(1e-12, np.abs(slope).sum()))
        for _ in range(20):
            new = point - length * way
            new_value, new_slope = evaluate(new)
            if new_value <= value - 1e-4 * length * (way @ slope):
                break
            length /= 2
        else:
            return point
        if (new - point) @ (new_slope - slope) > 1e-12:
            moves = [*moves[-9:], (new - point, new_slope - slope)]
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        point, value, slope = new, new_value, new_slope
        if done:
            break
    return point


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    documents: int = FIT_DOCUMENTS,
) -> np.ndarray:
    """Weights learned from at most ``documents`` labelled documents for which ``usable`` (of the id) holds.

    Labels other than 0 and 1 and rows without an id are left out; of several labels of an id the largest counts.
    Without labelled documents all weights are zero.
    """
    spark = docs.sparkSession
    ready(spark)
    given = labels.select(F.col(f"`{id}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    given = given.where("key is not null and label in (0, 1)").groupBy("key").agg(F.max("label").alias("label"))
    if usable is not None:
        given = given.where(usable)
    sample = F.broadcast(given.orderBy(F.xxhash64("key"), "key").limit(documents))
    chosen = docs.select(F.col(f"`{id}`").alias("key"), F.col(f"`{text}`").alias("text")).join(sample, "key")

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, marks = (column.to_pylist() for column in batch.columns)
            found = [own_features(value or "")[0] for value in values]
            columns = [pa.array(marks, pa.int32()), pa.array([len(x) for x in found], pa.int32())]
            columns.append(pa.array([x.tobytes() for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["label", "n", "own"])

    rows = chosen.select("text", "label").mapInArrow(describe, "label int, n int, own binary")
    described, path = written(rows, "line-features")

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, slope, count = 0.0, np.zeros(len(weights)), 0
            for batch in batches:
                if batch.num_rows:
                    marks, sizes, own = batch.columns
                    own = np.frombuffer(b"".join(own.to_pylist()), np.float32).reshape(-1, OWN)
                    part = likelihood(weights, own, sizes.to_numpy().astype(np.int64), marks.to_numpy().astype(np.int64))
                    total, slope, count = total + part[0], slope + part[1], count + batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([total]), pa.array([slope.tobytes()], pa.binary()), pa.array([count], pa.int64())],
                ["loss", "slope", "n"],
            )

        parts = described.mapInArrow(partial, "loss double, slope binary, n long").collect()
        count = max(1, sum(row.n for row in parts))
        loss = sum(row.loss for row in parts) / count + PENALTY * float(weights @ weights) / 2
        return loss, sum(np.frombuffer(row.slope) for row in parts) / count + PENALTY * weights

    start = np.zeros(FEATURES + 4)
    weights = start if described.isEmpty() else lbfgs(evaluate, start, ROUNDS)
    discard(spark, path)
    return weights


def score_batch(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    described = [own_features(text or "") for text in texts]
    if not described:
        return np.zeros(0)
    sizes = np.array([len(own) for own, _ in described])
    features = with_neighbours(np.concatenate([own for own, _ in described]), sizes)
    single, _, _ = forward_backward(features @ weights[:FEATURES], weights[FEATURES:].reshape(2, 2), sizes)
    lengths, first = np.concatenate([n for _, n in described]), np.cumsum(sizes) - sizes
    mean = np.add.reduceat(np.exp(single[:, 1]) * lengths, first) / np.add.reduceat(lengths, first)
    return np.clip(mean, 0.0, 1.0)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the quality of each whole text, from 0 to 1.

    A null or empty text is one empty line. Texts of any length are read whole. Each row stands for itself, so ties
    and repeated rows are kept, and an empty table stays empty. A column named ``out`` is replaced, others stay.
    """
    ready(docs.sparkSession)
    compute = lambda: lambda texts: [pa.array(score_batch(texts, weights), pa.float64())]
    return with_columns(docs, text, [T.StructField(out, T.DoubleType(), True)], compute)
