"""Tables are broadcast by their measured size."""

from pyspark.sql import functions as F
from test_llm_native import found_in

from ombuds.llm import common, decontaminate


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_rows_of_different_sizes_are_summed(spark):
    rows = spark.createDataFrame([(1, [1] * 5000), (2, [1])], "id long, places array<int>")
    assert hinted(common.small_or_shuffled(rows, "test", 100, most=1000))
    size = F.size("places") * 12
    assert not hinted(common.small_or_shuffled(rows, "test", size, most=1000))
    assert hinted(common.small_or_shuffled(rows, "test", size, most=60_012))
    assert hinted(common.small_or_shuffled(rows.where("false"), "test", size, most=0))


def test_places_of_a_long_document_are_not_broadcast(spark, monkeypatch):
    small, seen = common.small_or_shuffled, {}

    def watched(df, label, size):
        kept = small(df, label, size, most=10_000)
        seen[label] = hinted(kept)
        return kept

    monkeypatch.setattr(decontaminate, "small_or_shuffled", watched)
    item = " ".join(f"w{i}" for i in range(8))
    long, short = [(1, f"{item} " * 300)], [(1, item)]
    assert found_in(spark, long, [(9, item)]) == {(1, 9): (1.0, 0)}
    assert seen["places"] is False
    assert found_in(spark, short, [(9, item)]) == {(1, 9): (1.0, 0)}
    assert seen["places"] is True
