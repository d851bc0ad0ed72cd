from itertools import product

import numpy as np
import pytest
from odd_docs import no_docs, odd_docs
from pyspark.sql import functions as F

from ombuds.llm import line_crf, queries

LARGER = "/root/testdata/sf0.01"


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 4, 2, 5, 1])
    scores, moves = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    single, pairs, normal = line_crf.forward_backward(scores, moves, sizes)
    begin = 0
    for chain, size in enumerate(sizes):
        mass, one, two = 0.0, np.zeros((size, 2)), np.zeros((size, 2, 2))
        for labels in product((0, 1), repeat=size):
            weight = np.exp(
                sum(scores[begin + i] * y for i, y in enumerate(labels))
                + sum(moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
            )
            mass += weight
            for i, y in enumerate(labels):
                one[i, y] += weight
                if i:
                    two[i, labels[i - 1], y] += weight
        assert normal[chain] == pytest.approx(np.log(mass))
        assert np.allclose(np.exp(single[begin : begin + size]), one / mass)
        assert np.allclose(pairs[begin : begin + size], two / mass)
        begin += size


def test_gradient_against_differences():
    rng = np.random.default_rng(2)
    sizes, labels = np.array([3, 1, 6, 2]), np.array([1, 0, 0, 1])
    own = rng.normal(size=(sizes.sum(), line_crf.OWN))
    weights = rng.normal(size=line_crf.FEATURES + 4) / 3
    _, slope = line_crf.likelihood(weights, own, sizes, labels)
    for place in range(len(weights)):
        step = np.zeros(len(weights))
        step[place] = 1e-5
        more, less = (line_crf.likelihood(weights + s * step, own, sizes, labels)[0] for s in (1, -1))
        assert slope[place] == pytest.approx((more - less) / 2e-5, abs=1e-6)


def test_neighbours_stay_within_a_document():
    own = np.arange(3 * line_crf.OWN, dtype=float).reshape(3, line_crf.OWN) + 1
    found = line_crf.with_neighbours(own, np.array([2, 1]))
    before, after = found[:, line_crf.OWN : 2 * line_crf.OWN], found[:, 2 * line_crf.OWN : 3 * line_crf.OWN]
    assert (before[1] == own[0]).all() and (after[0] == own[1]).all()
    assert not before[0].any() and not before[2].any() and not after[1].any() and not after[2].any()


def test_minimiser():
    target = np.array([3.0, -2.0, 0.5])
    scale = np.array([1.0, 50.0, 0.1])
    bowl = lambda x: (float((scale * (x - target) ** 2).sum()), 2 * scale * (x - target))
    assert np.allclose(line_crf.lbfgs(bowl, np.zeros(3), 60), target, atol=1e-2)


def test_held_out_accuracy_of_the_query(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    found = queries.op1_line_crf(spark, LARGER)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == 1000 and len(rows) > 40
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.9
    # No clean document is rejected.
    assert sum(r.predicted == 0 for r in rows if r.quality == 1) == 0


def test_odd_rows(spark):
    docs = odd_docs(spark)
    weights = np.linspace(-1, 1, line_crf.FEATURES + 4)
    rows = line_crf.score(docs, weights).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text or "", row.score) == row.score
    assert set(line_crf.score(docs, weights).columns) == {*docs.columns, "score"}
    assert line_crf.score(no_docs(spark), weights).count() == 0


def test_labels_that_say_nothing(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 7), (99, 0)], "doc_id long, quality int")
    assert not line_crf.fit(docs, labels).any()
    assert not line_crf.fit(docs, spark.createDataFrame([(1, 1)], labels.schema), F.lit(False)).any()
    for row in line_crf.score(docs, np.zeros(line_crf.FEATURES + 4)).collect():
        assert row.score == pytest.approx(0.5)


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] * 2, "doc_id long, quality int")
    one = line_crf.fit(docs, labels, documents=1)
    assert np.abs(one).sum() > 0 and (one == line_crf.fit(docs, labels, documents=1)).all()
