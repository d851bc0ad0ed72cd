"""Columns of the user that have the names of inner ones come out as they went in."""

import corpus_pipeline
import pytest
from ombuds.llm import common, decontaminate, line_chunks, simhash_groups
from pyspark.sql import functions as F

INNER = "__id __mark __doc __fp __turn __lines __ends __hashes __long __chunks __gone __places __chunk_of __filled __quality own_0".split()
PASSAGE = " ".join(f"word{n}" for n in range(60))


@pytest.fixture
def docs(spark):
    texts = ["first\n" + PASSAGE + "\nlast", "other\n" + PASSAGE, "a text of its own that nobody has", "", None]
    plain = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return plain.select("*", *(F.concat(F.lit(f"{name} of "), "doc_id").alias(name) for name in INNER))


@pytest.mark.parametrize("work", ["lines", "groups", "benchmark", "stage"])
def test_columns_keep_their_values(spark, docs, work):
    items = spark.createDataFrame([(1, "nothing like this is anywhere in there")], "item_id long, text string")

    def run(df):
        if work == "benchmark":
            return decontaminate.drop_contaminated(df, items)
        if work == "stage":
            return corpus_pipeline.lines(spark, df, "")
        return {"lines": line_chunks.dedup_lines, "groups": simhash_groups.keep_one}[work](df)

    got = run(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = got.collect()
    plain = run(docs.select("doc_id", "text")).collect()
    assert sorted((row.doc_id, str(row.text)) for row in rows) == sorted((row.doc_id, str(row.text)) for row in plain)
    assert all(row[name] == f"{name} of {row.doc_id}" for row in rows for name in INNER)


def test_a_key_may_have_such_a_name_too(docs):
    renamed = docs.drop("__id", "__lines").withColumnsRenamed({"doc_id": "__id", "text": "__lines"})
    got = line_chunks.dedup_lines(renamed, id="__id", text="__lines")
    assert sorted(row["__id"] for row in got.collect()) == [0, 1, 2, 3, 4]
    assert common.free_name(docs, "__ID") == "__ID_"
