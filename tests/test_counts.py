"""Counts that writes leave about themselves."""

import datetime as dt

from conftest import rows
from pyspark.sql import types as T

from checks import queries
from ombuds.operators.tables import VersionedTable
from ombuds.plans import pipeline

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("_ingestion_time", T.TimestampNTZType())]
)


def test_counts_follow_every_kind_of_write(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", SCHEMA, "id", 4)
    at = dt.datetime(2025, 1, 1)

    def frame(*ids):
        return spark.createDataFrame([(i, "x", at) for i in ids], SCHEMA)

    assert table.counts().count() == 0
    table.replace(frame(*map(str, range(20))))
    table.merge(frame(*map(str, range(15, 30)), None))
    table.erase(spark.createDataFrame([("3",), ("16",), ("no",)], "id string"), "id")
    table.replace(frame("a", "b"))
    table.revert(3)
    assert rows(table.counts()) == [(1, 20), (2, 31), (3, 29), (4, 2), (5, 29)]
    assert table.read().count() == 29 and table.read(2).count() == 31


def test_reconciling_reads_no_layer(spark):
    found = queries.QUERIES["reconcile_layers"](spark, SMALL)
    read = found.inputFiles()
    assert read and all(any(f"/{part}/" in path for part in ("pointer", "loads", "builds")) for path in read)
    assert {row.layer for row in found.collect()} == {"delivered", "raw", "mart"}


def test_nothing_loaded(spark, folder):
    house = pipeline.Warehouse(spark, f"{folder}/landed", f"{folder}/house", 2)
    assert pipeline.reconciled(house).count() == 0
