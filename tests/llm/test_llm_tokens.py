import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from odd_docs import no_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ombuds.llm import bpe, queries, token_counts
from ombuds.llm.bytebpe import Vocabulary, encoder
from ombuds.llm.common import CACHED_CHARS, Cache, WordCache

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts():
    random.seed(5)
    pool = "aab \t\n\r\x0b\x1c\x1d\x85\xa0 　éß中🙂‍①²٣'s't'llDONT.,!?’—<|endoftext|>ĀǅʰªºⅧ﻿"
    yield from ("", "<|endoftext|>", "a" * 30, " " * 40, "\x00\x01", "Ünï 's 'S")
    for _ in range(400):
        yield "".join(random.choice(pool) for _ in range(random.randint(1, 40)))
    for _ in range(300):
        yield "".join(random.choice("aeinotsrh ") for _ in range(random.randint(1, 60)))
    for _ in range(100):
        yield "".join(chr(random.choice([random.randint(0, 0x2FF), random.randint(0xE000, 0x10FFFF)])) for _ in range(30))


def test_ids_and_text_are_the_librarys(library):
    for text in random_texts():
        want = library.encode(text, add_special_tokens=False).ids
        got = memoryview(bpe.packed_ids(text, PATH)).cast("i").tolist()
        assert got == want, text
        assert bpe.spelled(got, PATH) == library.decode(want, skip_special_tokens=False)


def test_each_prefix_has_one_last_token(library):
    encode = encoder(PATH).encode
    for word in ("unbelievable", "ththeren", "aaaaaaa", "zzzzzzzz", "onanhe"):
        for end in range(1, len(word) + 1):
            assert encode(word[:end].encode()) == library.encode(word[:end], add_special_tokens=False).ids


def test_encode_keeps_rows_and_columns(spark, library):
    coded = bpe.encode_decode(odd_docs(spark), PATH)
    assert set(coded.columns) == {*odd_docs(spark).columns, "decoded"}
    rows = coded.collect()
    assert len(rows) == odd_docs(spark).count()
    for row in rows:
        assert list(row.ids) == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "")
    apart = bpe.decode(bpe.encode(odd_docs(spark), PATH), PATH).collect()
    assert sorted(map(str, apart)) == sorted(map(str, rows))
    assert bpe.encode(no_docs(spark), PATH).count() == 0


def test_decode_of_nothing_and_of_cut_characters(spark):
    frame = spark.createDataFrame([(None,), ([],), ([5, 6],), ([0xA0],)], "ids array<int>")
    got = [row.decoded for row in bpe.decode(frame, PATH).collect()]
    vocabulary = Vocabulary(PATH)
    assert got[:2] == [None, ""]
    assert got[2] == (vocabulary.bytes_of[5] + vocabulary.bytes_of[6]).decode()
    assert got[3] == vocabulary.bytes_of[0xA0].decode("utf-8", "replace")


def test_counts_are_the_librarys(spark, library):
    counted = token_counts.count_tokens(odd_docs(spark), PATH)
    for row in counted.collect():
        assert row.n_tokens == len(library.encode(row.text or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(no_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("share", [1 / 50, 1e-9])
def test_counts_do_not_depend_on_the_frequent_table(spark, share):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")
    few = token_counts.count_tokens(docs, PATH, share=share).select("doc_id", "n_tokens")
    assert few.exceptAll(token_counts.count_tokens(docs, PATH).select("doc_id", "n_tokens")).count() == 0


def test_frequent_table_is_bounded_by_its_share(spark):
    docs = spark.createDataFrame([("a b c d " * 50,), ("a b " * 100,)], "text string").repartition(2)
    found = token_counts.frequent_lengths(docs, PATH, share=0.2)
    assert {" a", " b"} <= set(found) and len(found) <= 5


def test_cache_is_bounded_and_keeps_what_is_in_use():
    asked = []
    cache = Cache(lambda key: asked.append(key) or key * 2, most=10)
    for key in range(100):
        assert cache[key] == key * 2 and cache[3] == 6
        assert len(cache) <= 10 and len(cache.old) <= 10
    assert asked.count(3) == 1


def test_long_words_are_not_cached(library):
    asked = []
    cache = WordCache(lambda word: asked.append(word) or len(word), most=10)
    for word in ("a" * CACHED_CHARS, "a" * (CACHED_CHARS + 1)) * 2:
        assert cache[word] == len(word)
    assert list(map(len, asked)) == [CACHED_CHARS, CACHED_CHARS + 1, CACHED_CHARS + 1] and len(cache) == 1
    long = "7" * 50_000 + " " + "Ab" * 50_000 + " x"
    ids = library.encode(long, add_special_tokens=False).ids
    assert np.frombuffer(bpe.packed_ids(long, PATH), bpe.ID).tolist() == ids
    assert max(map(len, [*bpe.packed_words(PATH), *bpe.packed_words(PATH).old])) <= CACHED_CHARS



def test_queries_match_the_library(spark, library):
    docs = {row.doc_id: row.text for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    counts = queries.op3_token_counts(spark, SMALL).collect()
    coded = {row.doc_id: row for row in queries.op10_bpe(spark, SMALL).collect()}
    assert len(counts) == len(coded) == len(docs)
    for row in counts:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        assert (row.n_tokens, row.n_bytes) == (len(ids), len(docs[row.doc_id].encode()))
        assert row.over_limit == (len(ids) > 512)
        other = coded[row.doc_id]
        assert other.n_tokens == len(ids)
        assert other.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert other.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_text_digests(spark):
    row = bpe.encode_decode(spark.createDataFrame([(None,)], "text string"), PATH).select(
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256), F.sha2("decoded", 256)
    )
    assert set(row.first()) == {hashlib.sha256(b"").hexdigest()}
