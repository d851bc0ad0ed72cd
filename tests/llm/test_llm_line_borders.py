"""Passages of whole lines go to their borders, whatever stands around them."""

import random

import pytest
from test_llm_native import WORDS, deduped, lines

from ombuds.llm import line_chunks, queries

SMALL = "/root/testdata/sf0.001"


def line(count):
    return " ".join(random.choices(WORDS, k=count))


def words(text):
    return text.count(" ") + 1 if text.strip(" ") else 0


def runs(texts):
    """All (top, last) of the fewest lines with 50 words, on and back from each line, by trying."""
    for at in range(len(texts)):
        for step in (1, -1):
            total, to = words(texts[at]), at
            while total and total < 50 and 0 <= to + step < len(texts):
                to += step
                total += words(texts[to])
            if total >= 50:
                yield min(at, to), max(at, to)


@pytest.mark.parametrize("count, each", [(2, 30), (3, 20), (4, 20), (4, 13), (6, 10), (6, 20)])
def test_passages_between_different_neighbours_go_whole(spark, count, each):
    random.seed(100 * count + each)
    rows, rests = [], []
    for _ in range(40):
        passage = [line(each) for _ in range(count)]
        for copy in range(2):
            before, after = [line(15) for _ in range(3)], [line(15) for _ in range(3)]
            rows.append("\n".join([*before, *passage, *after]))
            rests.append(rows[-1] if not copy else "\n".join([*before, *after]))
    got = deduped(spark, lines(*rows), borders=True)
    assert [got[i] for i in range(len(rows))] == rests
    assert deduped(spark, lines(*rows)) != got


def test_less_than_a_passage_stays(spark):
    random.seed(5)
    passage = [line(16) for _ in range(3)]
    rows = lines(*("\n".join([line(15), passage[0], "", passage[1], passage[2], line(15)]) for _ in range(2)))
    assert set(passage) <= set(deduped(spark, rows, borders=True, lines=1 << 30)[1].split("\n"))
    blank = lines("a" + "\n" * 120 + "b", "c" + "\n" * 120 + "d")
    assert deduped(spark, blank, borders=True, lines=1 << 30) == dict(blank)


def test_repeats_within_a_document_leave_each_line_somewhere(spark):
    random.seed(6)
    pool = [line(n) for n in (12, 20, 30, 30, 49, 60)]
    texts = ["\n".join(random.choices([*pool, ""], k=random.randint(1, 12))) for _ in range(50)]
    got = deduped(spark, lines(*texts), borders=True)
    before, after = ({x for text in some for x in text.split("\n") if x} for some in (texts, got.values()))
    assert before == after and sum(map(len, got.values())) < sum(map(len, texts))


def test_query_takes_all_repeated_passages(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) > 0").orderBy("doc_id").collect()
    first, gone = {}, {r.doc_id: set() for r in rows}
    for row in rows:
        texts = row.text.split("\n")
        for top, last in sorted(set(runs(texts))):
            if first.setdefault("\n".join(texts[top : last + 1]), (row.doc_id, top)) != (row.doc_id, top):
                gone[row.doc_id].update(range(top, last + 1))
    old = {r.doc_id: r for r in queries.op8_line_chunks(spark, SMALL).collect()}
    whole = {r.doc_id: r for r in queries.op8_whole_passages(spark, SMALL).collect()}
    assert whole.keys() == old.keys()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = {r.doc_id: r.text for r in line_chunks.dedup_lines(docs, borders=True).collect()}
    more = 0
    for row in rows:
        number, texts, kept = row.doc_id, row.text.split("\n"), left[row.doc_id]
        assert whole[number].n_chars == len(kept) and whole[number].removed_lines >= max(old[number].removed_lines, len(gone[number]))
        # What stays is in order among the lines that no passage takes.
        rest = iter([x for i, x in enumerate(texts) if i not in gone[number]])
        assert not kept or all(x in rest for x in kept.split("\n"))
        more += whole[number].removed_lines - old[number].removed_lines
    assert more == 6


def test_broadcast_or_shuffle_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in line_chunks.dedup_lines(docs, borders=True).collect()}
    small = line_chunks.small_or_shuffled
    monkeypatch.setattr(line_chunks, "small_or_shuffled", lambda df, label, size: small(df, label, size, most=-1))
    assert {r.doc_id: r.text for r in line_chunks.dedup_lines(docs, borders=True).collect()} == before
