import math
import random
from collections import defaultdict

import numpy as np
import pytest
from odd_docs import no_docs, odd_docs
from pyspark.sql import functions as F

from ombuds.llm import context_tree, queries

SMALL = "/root/testdata/sf0.001"


def sequence(text):
    return b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n"


def decisions(body):
    """(context, bits before, bit) of each binary decision."""
    padded = b"\n" * context_tree.DEPTH + body
    for at in range(context_tree.DEPTH, len(padded)):
        bits = f"{padded[at]:08b}"
        for n in range(8):
            yield padded[at - context_tree.DEPTH : at], bits[:n], int(bits[n])


class Tree:
    """The same model with a dictionary of nodes, node by node."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        for text in texts:
            for context, before, bit in decisions(sequence(text)):
                for depth in range(context_tree.DEPTH + 1):
                    self.counts[context[len(context) - depth :], before][bit] += 1
        self.children = defaultdict(list)
        for context, before in self.counts:
            if context:
                self.children[context[1:], before].append((context, before))
        self.known = {}
        for node in sorted(self.counts, key=lambda node: -len(node[0])):
            zeros, ones = self.counts[node]
            own = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
            below = sum(self.known[child][0] for child in self.children[node])
            total = own if len(node[0]) == context_tree.DEPTH else np.logaddexp(own, below) - math.log(2)
            self.known[node] = total, math.exp(own - math.log(2) - total)

    def chance(self, context, before, bit):
        chance = None
        for depth in range(context_tree.DEPTH, -1, -1):
            node = context[len(context) - depth :], before
            if node in self.known:
                own = (self.counts[node][bit] + 0.5) / (sum(self.counts[node]) + 1)
                weight = self.known[node][1]
                chance = own if chance is None else weight * own + (1 - weight) * chance
        return 0.5 if chance is None else chance

    def score(self, text):
        return sum(math.log10(self.chance(*decision)) for decision in decisions(sequence(text)))


def unigram(texts, text):
    counts = defaultdict(int)
    for other in texts:
        for token in [*(other or "").encode().lower().split(), None]:
            counts[token] += 1
    total, distinct = sum(counts.values()), len(counts)
    own = [*(text or "").encode().lower().split(), None]
    return (
        sum(math.log10((counts.get(t, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for t in own),
        len(own),
        sum(counts.get(t, 0) > 0 for t in own),
        total,
    )


def compare(rows, train):
    tree = Tree(train)
    for row, text in rows:
        assert row.score == pytest.approx(tree.score(text), rel=1e-7)
        base, n_tokens, n_known, total = unigram(train, text)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n_tokens, n_known, total)
        assert row.n_bytes == len(sequence(text))
        assert row.bits_per_byte == pytest.approx(-tree.score(text) / math.log10(2) / len(sequence(text)), rel=1e-7)


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (300, 500)])
def test_scores_against_a_dictionary_of_nodes(spark, sizes):
    random.seed(4)
    words = ["the", "then", "on", "onther", "wá", "X1", "éa", "a"]
    texts = {i: " ".join(random.choices(words, k=random.randint(0, 12))) for i in range(40)}
    texts |= {100: None, 101: "", 102: "quite new wörds", 103: " \n the\tTHE "}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    held = F.col("doc_id").isin([3, 7, 100, 102])
    found = context_tree.score_texts(docs, held, block_bytes=sizes[0], part_bytes=sizes[1]).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    assert {r.doc_id for r in found if r.held_out} == {3, 7, 100, 102}
    compare([(r, texts[r.doc_id]) for r in found], [t for i, t in texts.items() if i not in (3, 7, 100, 102)])


def test_bundles_of_reports_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the {'on ' * i} word{i % 3}") for i in range(30)], "doc_id long, text string")
    held = F.col("doc_id") % 5 == 0
    one = context_tree.score_texts(docs, held, block_bytes=100).orderBy("doc_id").collect()
    monkeypatch.setattr(context_tree, "MERGED", 2)
    many = context_tree.score_texts(docs, held, block_bytes=100).orderBy("doc_id").collect()
    for a, b in zip(one, many, strict=True):
        assert a.score == pytest.approx(b.score, rel=1e-7) and a.base_score == pytest.approx(b.base_score, rel=1e-12)


def test_levels_give_the_same_and_rows_grow_with_the_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the {'on ' * i} word{i % 3} {i * 7919}") for i in range(60)], "doc_id long, text string")
    held = F.col("doc_id") % 5 == 0
    one = context_tree.score_texts(docs, held).orderBy("doc_id").collect()
    monkeypatch.setattr(context_tree, "MERGED", 3)
    monkeypatch.setattr(context_tree, "FAN", 3)
    assert context_tree.levels(20, 30) == [9, 3, 1, 1] and context_tree.levels(1, 0) == [1]
    many = context_tree.score_texts(docs, held, block_bytes=150, part_bytes=400).orderBy("doc_id").collect()
    for a, b in zip(one, many, strict=True):
        assert a.score == pytest.approx(b.score, rel=1e-7) and a.base_score == pytest.approx(b.base_score, rel=1e-12)
        assert (a.n_known, a.n_tokens, a.train_tokens) == (b.n_known, b.n_tokens, b.train_tokens)
    plain = docs.select(F.col("doc_id").alias("id"), held.alias("held"), "text").repartition(4)
    blocks = context_tree.packed(plain, 150).persist()
    n_blocks, parts = blocks.count(), 20
    *asked, (known, _) = context_tree.through_levels(blocks, parts, n_blocks)
    # Strings and words: each sender deals to at most three shares, however many parts there are.
    senders = n_blocks
    for level, _ in asked:
        assert level.count() <= senders * 2 * 3
        senders = level.select("words", "part", "bundle").distinct().count()
        assert level.groupBy("words", "part", "bundle").count().agg(F.max("count")).first()[0] <= n_blocks
    assert known.groupBy("words", "part").count().where("count > 1").count() == 0
    assert known.select("part").distinct().count() <= parts
    blocks.unpersist()


def test_odd_rows_and_no_training(spark):
    docs = odd_docs(spark).where(F.coalesce(F.length("text"), F.lit(0)) < 1000)
    rows = docs.collect()
    found = context_tree.score_texts(docs, F.lit(False)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in rows)
    texts = [r.text for r in rows]
    by_size = {(str(r.doc_id), len(sequence(r.text))): r.text for r in rows}
    compare([(r, by_size[str(r.doc_id), r.n_bytes]) for r in found], texts)
    for row in context_tree.score_texts(docs, F.lit(True)).collect():
        assert row.score == pytest.approx(8 * row.n_bytes * math.log10(0.5)) and row.base_score == 0
        assert (row.n_known, row.train_tokens) == (0, 0)
    assert context_tree.score_texts(no_docs(spark), F.lit(False)).count() == 0
    assert context_tree.score_texts(odd_docs(spark), F.lit(None).cast("boolean")).where("not held_out").count() == 13


def test_query_beats_the_unigram_model_on_held_out_texts(spark):
    found = queries.op2_context_tree(spark, "/root/testdata/sf0.01")
    row = found.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert found.count() == 1000 and row[2] > 50 and row[0] > row[1]


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 50, 0.5), [1e3 + 0.5, 1e6, 1e9 + 0.5]])
    assert np.allclose(context_tree.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-10)
