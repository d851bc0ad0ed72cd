import pytest

from conftest import plan, rows
from ombuds.operators import quality
from ombuds.operators.quality import Expectations, Reference


@pytest.fixture
def calls(spark):
    data = [("1", "a"), ("1", "a"), ("2", "b"), ("3", "zz"), ("4", "zz"), ("5", None), (None, "b"), (None, "a")]
    return spark.createDataFrame(data, "call_id string, agent_id string")


@pytest.fixture
def agents(spark):
    return spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "agent_id string")


def test_unique_ignores_nulls(calls):
    assert rows(quality.unique(calls, "calls", "call_id")) == [("unique", "calls", "call_id", 1)]
    assert rows(quality.duplicate_keys(calls, "call_id")) == [("1", 2)]


def test_not_null_takes_one_pass(calls):
    df = quality.not_null(calls, "calls", ["call_id", "agent_id"])
    assert rows(df) == [("not_null", "calls", "agent_id", 1), ("not_null", "calls", "call_id", 2)]
    assert plan(df).count("Scan ") == 1


def test_relationships_count_orphan_rows(calls, agents):
    df = quality.relationships(calls, "calls", "agent_id", agents, "agent_id")
    assert rows(df) == [("relationships", "calls", "agent_id", 2)]
    assert rows(quality.orphan_rows(calls, "agent_id", agents, "agent_id"), "call_id") == [("3",), ("4",)]


def test_no_orphans_is_zero(calls, spark):
    parent = spark.createDataFrame([("a",), ("b",), ("zz",)], "agent_id string")
    assert quality.relationships(calls, "calls", "agent_id", parent, "agent_id").first().failures == 0


def test_child_rows_are_counted_before_the_join(calls, agents):
    text = plan(quality.relationships(calls, "calls", "agent_id", agents, "agent_id"))
    join = text.index("LeftAnti")
    assert "partial_count" in text[join:]


def test_accepted_values(calls):
    df = quality.accepted_values(calls, "calls", "agent_id", ["a", "b"])
    assert df.first().failures == 2


def test_row_counts(calls, agents):
    assert rows(quality.row_counts({"calls": calls, "agents": agents})) == [("agents", 4), ("calls", 8)]


def test_requirements(calls):
    assert quality.require_columns(calls, ["call_id"]) is calls
    with pytest.raises(quality.QualityError, match="nope"):
        quality.require_columns(calls, ["nope", "call_id"])
    assert quality.require_rows(calls) is calls
    with pytest.raises(quality.QualityError):
        quality.require_rows(calls.limit(0))


def test_suite(calls, agents):
    expected = {
        "calls": Expectations(
            unique=("call_id",),
            not_null=("call_id",),
            references=(Reference("agent_id", "agents", "agent_id"),),
            accepted=(("agent_id", ("a", "b", "zz")),),
        ),
        "agents": Expectations(unique=("agent_id",)),
        "absent": Expectations(unique=("x",)),
    }
    assert rows(quality.run_suite({"calls": calls, "agents": agents}, expected)) == [
        ("accepted_values", "calls", "agent_id", 0),
        ("not_null", "calls", "call_id", 2),
        ("relationships", "calls", "agent_id", 2),
        ("unique", "agents", "agent_id", 1),
        ("unique", "calls", "call_id", 1),
    ]


def test_suite_reads_each_table_once(spark, folder, calls, agents):
    calls.write.parquet(f"{folder}/calls")
    agents.write.parquet(f"{folder}/agents")
    expected = {
        "calls": Expectations(("call_id", "agent_id"), ("call_id", "agent_id"), (Reference("agent_id", "agents", "agent_id"),)),
        "agents": Expectations(("agent_id",), ("agent_id",)),
    }
    suite = quality.run_suite({name: spark.read.parquet(f"{folder}/{name}") for name in expected}, expected)
    assert plan(suite).count("FileScan parquet") == 2
    found = {(row.test, row.table, row.column): row.failures for row in suite.collect()}
    assert found == {
        ("unique", "calls", "call_id"): 1, ("unique", "calls", "agent_id"): 3, ("not_null", "calls", "call_id"): 2,
        ("not_null", "calls", "agent_id"): 1, ("relationships", "calls", "agent_id"): 2, ("unique", "agents", "agent_id"): 1,
        ("not_null", "agents", "agent_id"): 1,
    }
    empty = {name: spark.read.parquet(f"{folder}/{name}").limit(0) for name in expected}
    assert {row.failures for row in quality.run_suite(empty, expected).collect()} == {0}


def test_declared_tests():
    raw, marts = quality.RAW_EXPECTATIONS.values(), quality.MART_EXPECTATIONS
    assert sum(len(e.unique) for e in raw) == 5 and sum(len(e.not_null) for e in raw) == 11
    named = [marts[name] for name in ("dim_customers", "dim_agents", "fct_calls")]
    assert sum(len(e.unique) + len(e.not_null) for e in named) == 6
    assert len(marts["fct_calls"].references) == 2
