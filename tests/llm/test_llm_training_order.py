import hashlib
import time

import numpy as np
import pytest
import tiktoken
from odd_docs import no_docs, odd_docs
from pyspark.sql import functions as F

from ombuds.llm import queries, training_order
from ombuds.llm.queries import END, PATTERN, RANKS

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [1, 2, 3, 15, 16, 17, 1000, 4096, 70_001])
def test_slots_are_a_bijection(size):
    slots = training_order.permuted(np.arange(size), size, 7)
    assert (np.sort(slots) == np.arange(size)).all()
    if size >= 1000:
        assert (slots != training_order.permuted(np.arange(size), size, 8)).mean() > 0.9
        assert abs(np.corrcoef(slots, np.arange(size))[0, 1]) < 0.1


def records(docs, length):
    encode = training_order.encoding(RANKS, PATTERN).encode_ordinary
    for number, text in docs:
        ids = [*encode(text or ""), END]
        for n, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            yield number, n, len(part), np.array(part + [END] * (length - len(part)), "<u2").tobytes()


def test_query_holds_every_sequence_once(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = queries.op7_training_order(spark, SMALL).collect()
    want = sorted((i, n, size, hashlib.md5(x).hexdigest()) for i, n, size, x in records(docs, training_order.LENGTH))
    assert sorted((r.doc_id, r.seq_no, r.n_tokens, r.record_md5) for r in rows) == want
    assert sorted(r.slot for r in rows) == list(range(len(want)))
    for row in rows:
        assert row.shard == row.slot // training_order.SHARD_SLOTS
        assert row.offset == row.slot % training_order.SHARD_SLOTS * 2 * training_order.LENGTH


def test_shards_are_ranges_and_can_be_resumed(spark, folder):
    docs = odd_docs(spark).repartition(3)
    total = training_order.materialise(docs, f"{folder}/out", RANKS, PATTERN, END, length=64, shard_slots=50)
    want = sorted((str(i), n, size, x) for i, n, size, x in records([(r.doc_id, r.text) for r in docs.collect()], 64))
    found = training_order.shards(spark, f"{folder}/out").collect()
    assert total == len(found) == len(want)
    assert sorted((str(r.doc_id), r.seq_no, r.n_tokens, bytes(r.record)) for r in found) == want
    assert {len(r.record) for r in found} == {128} and {(r.slot // 50) for r in found} == {r.shard for r in found}
    # One file per shard, its rows in the order of slots.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    paths = [r.path for r in files.load(f"{folder}/out").select("path").collect()]
    assert len(paths) == -(-total // 50)
    for path in paths:
        slots = [r.slot for r in spark.read.parquet(path).collect()]
        assert slots == sorted(slots)
    by_slot = {r.slot: r.record for r in found}
    got = [(r.slot, r.record) for r in training_order.resume(spark, f"{folder}/out", 45, 60, 50).collect()]
    assert got == [(slot, by_slot[slot]) for slot in range(45, 105)]


def test_ids_lead_back_to_the_texts(spark, folder):
    docs = spark.createDataFrame([(1, "héllo <|endoftext|> wörld " * 40), (2, "b")], "doc_id long, text string")
    training_order.materialise(docs, f"{folder}/out", RANKS, PATTERN, END, length=16)
    found = training_order.shards(spark, f"{folder}/out").orderBy("doc_id", "seq_no").collect()
    ids = {n: [x for r in found if r.doc_id == n for x in np.frombuffer(r.record, "<u2")[: r.n_tokens].tolist()] for n in (1, 2)}
    encoding: tiktoken.Encoding = training_order.encoding(RANKS, PATTERN)
    for row in docs.collect():
        assert ids[row.doc_id][-1] == END and encoding.decode(ids[row.doc_id][:-1]) == row.text


def test_empty_table(spark, folder):
    assert training_order.materialise(no_docs(spark), f"{folder}/none", RANKS, PATTERN, END) == 0


def test_records_lie_at_their_places(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    total = training_order.materialise(odd_docs(spark).repartition(3), out, RANKS, PATTERN, END, length=64, shard_slots=50)
    by_slot = {r.slot: bytes(r.record) for r in training_order.shards(spark, out).collect()}
    files = {int(file.parent.name.removeprefix("shard=")): file for file in tmp_path.glob("out/records/shard=*/part-*")}
    assert sorted(files) == list(range(-(-total // 50)))
    for slot in range(total):
        with files[slot // 50].open("rb") as file:
            file.seek(slot % 50 * 128)
            assert file.read(128) == by_slot[slot]
    for first, count in ((45, 60), (0, 1), (total - 3, 10), (total, 5), (99, 2)):
        ids = training_order.read_ids(spark, out, first, count)
        wanted = [by_slot[slot] for slot in range(first, min(total, first + count))]
        assert [row.tobytes() for row in ids] == wanted
        assert [bytes(r.record) for r in training_order.resume(spark, out, first, count).collect()] == wanted


def test_bytes_of_all_values_come_back(spark, folder):
    text = "".join(map(chr, range(1, 3000)))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    training_order.materialise(docs, f"{folder}/out", RANKS, PATTERN, END, length=8)
    ids = training_order.read_ids(spark, f"{folder}/out", 0, 1 << 20)
    want = sorted(x for _, _, _, x in records([(1, text)], 8))
    assert sorted(row.tobytes() for row in ids) == want


def test_ids_that_do_not_fit(spark, folder):
    with pytest.raises(ValueError, match="don't fit"):
        training_order.materialise(odd_docs(spark), f"{folder}/out", RANKS, PATTERN, 70_000)


def test_shards_are_written_in_turns_whose_shuffles_go(spark, folder, monkeypatch):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = (files.apply(at) for at in range(files.size()))
        return sum(file.length() for file in found if file.getName().endswith(".data"))

    left, write = [], training_order._write_files
    docs = spark.range(400).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 9).alias("text")).repartition(4)

    def watched(*args):
        before = shuffled()
        write(*args)
        for _ in range(200):  # files are deleted in the background
            if shuffled() <= before:
                break
            time.sleep(0.1)
        left.append(shuffled() - before)

    monkeypatch.setattr(training_order, "_write_files", watched)
    total = training_order.materialise(docs, f"{folder}/out", RANKS, PATTERN, END, id="id", length=64, shard_slots=500)
    assert len(left) == training_order.WAVES and total > 500 * training_order.WAVES
    found = training_order.shards(spark, f"{folder}/out")
    want = sorted(x for _, _, _, x in records([(r.id, r.text) for r in docs.collect()], 64))
    assert sorted(bytes(r.record) for r in found.collect()) == want
    assert max(left) <= 0
