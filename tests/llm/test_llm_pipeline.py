import duckdb
import public_tokenizers
from odd_docs import odd_docs
from test_llm_simhash import plain_components
from tokenizers import Tokenizer

import corpus_pipeline
from ombuds.llm import decontaminate, line_chunks, line_crf, queries

SMALL = "/root/testdata/sf0.001"


def cut_by_hand(docs):
    """Texts after line dedup, by the general interface."""
    return {r.doc_id: r.text for r in line_chunks.dedup_lines(docs).collect()}


def test_stages_against_brute_force(spark):
    """Each stage, on what the one before it kept, against a plain version of it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    first = corpus_pipeline.quality(spark, docs, SMALL)
    weights = queries.quality_weights(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = docs.collect()
    want = {r.doc_id for r in rows if line_crf.score_batch([r.text], weights)[0] >= queries.QUALITY}
    assert {r.doc_id for r in first.collect()} == want and 0 < len(want) < len(rows)
    first, _ = corpus_pipeline.written(first, "test")

    second = corpus_pipeline.lines(spark, first, SMALL)
    connection = duckdb.connect()
    connection.register("documents", first.toPandas())
    removed = connection.execute(line_chunks.ORACLE).fetchdf().set_index("doc_id")
    found = {r.doc_id: r for r in second.collect()}
    emptied = {i for i, text in cut_by_hand(first).items() if not text.strip()} & {r.doc_id for r in first.collect() if r.text.strip()}
    assert found.keys() == want - emptied and emptied and removed.removed_lines.sum() > 0
    for number, row in found.items():
        assert row.n_chars == len(row.text) == removed.n_chars[number]
    second, _ = corpus_pipeline.written(second, "test")

    third = corpus_pipeline.near_duplicates(spark, second, SMALL)
    rows = [(r.doc_id, r.text) for r in second.collect()]
    kept = {int(c) for _, _, c in plain_components(rows, 2)}
    assert {r.doc_id for r in third.collect()} == kept and len(kept) < len(rows)
    third, _ = corpus_pipeline.written(third, "test")

    fourth = corpus_pipeline.benchmark(spark, third, SMALL)
    connection = duckdb.connect()
    connection.register("documents", third.toPandas())
    connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SMALL}/benchmark.parquet'")
    leaks = set(connection.execute(decontaminate.ORACLE).fetchdf().doc_id)
    assert {r.doc_id for r in fourth.collect()} == kept - leaks and leaks
    for stage in (first, second, third, fourth):
        assert stage.columns == columns

    last = {r.doc_id: r for r in corpus_pipeline.tokens(spark, fourth, SMALL).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in fourth.collect():
        assert list(last[row.doc_id].ids) == library.encode(row.text, add_special_tokens=False).ids
        assert last[row.doc_id].decodes and last[row.doc_id].n_tokens == len(last[row.doc_id].ids)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == last.keys()


def test_stages_keep_odd_rows_and_their_columns(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.where("false")):
            found = stage(spark, given, SMALL)
            rows = found.collect()
            assert len(rows) <= given.count()
            if name != "tokens":
                assert found.columns == docs.columns
            if name == "tokens":
                assert len(rows) == given.count()
            if name == "lines":
                # Document 2 is a copy of document 1.
                assert {r.doc_id for r in given.collect()} - {r.doc_id for r in rows} <= {2}


def test_documents_that_lines_leave_empty_go(spark):
    text = "one line\nand another"
    docs = spark.createDataFrame([(1, text), (2, text), (3, ""), (4, None), (5, " \n")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, SMALL).collect()}
    assert kept == {1: text, 3: "", 4: None, 5: " \n"}


def test_stage_names_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None
