"""Data-quality tests. Each returns ``(test, table, column, failures)``; rows that fail stay distributed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A frame lacks required columns or rows."""


# one test


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their row count (pre-aggregated per task)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") > 1)


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Failures = number of repeated values."""
    return _result("unique", table, column, duplicate_keys(df, column).agg(F.count(F.lit(1)).alias("failures")))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Failures = NULLs per column."""
    return row_tests(df, table, [_null_test(name) for name in columns])


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Failures = rows with a non-NULL value outside ``values``."""
    return row_tests(df, table, [_value_test(column, values)])


def _null_test(column: str) -> tuple[str, str, Column]:
    return "not_null", column, F.col(column).isNull()


def _value_test(column: str, values: Sequence[str]) -> tuple[str, str, Column]:
    return "accepted_values", column, ~F.col(column).isin(*values)


def row_tests(df: DataFrame, table: str, tests: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Tests ``(test, column, failing)`` that look at single rows; all of a table take one pass."""
    counts = df.agg(*(F.count_if(fails).alias(f"n{i}") for i, (_, _, fails) in enumerate(tests)))
    results = (
        F.struct(
            F.lit(test).alias("test"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.col(f"n{i}").alias("failures"),
        )
        for i, (test, column, _) in enumerate(tests)
    )
    return counts.select(F.inline(F.array(*results)))


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is not NULL and absent from the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Failures = orphan rows. Child rows are counted per key first, so a hot key is one row in the join."""
    per_key = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    orphans = orphan_rows(per_key, column, parent, parent_column)
    total = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("failures"))
    return _result("relationships", table, column, total)


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per layer, to reconcile one layer against the next."""
    counts = (
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    )
    return _union(counts)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise QualityError(f"missing columns: {missing}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise QualityError("no rows")
    return df


# the declared suite


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Expectations:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()


# Which column is tested for what.
RAW_EXPECTATIONS = {
    "customers": Expectations(unique=("customer_id",), not_null=("customer_id", "email")),
    "agents": Expectations(unique=("id",), not_null=("id",)),
    "call_center_logs": Expectations(unique=("call_id",), not_null=("call_id", "customer_id", "agent_id")),
    "web_complaints": Expectations(unique=("request_id",), not_null=("request_id", "customer_id")),
    "social_media": Expectations(
        unique=("complaint_id",), not_null=("complaint_id", "customer_id", "media_channel")
    ),
}
CHANNELS = ("Call Center", "Web Form", "Social Media")
MART_EXPECTATIONS = {
    "dim_customers": Expectations(unique=("customer_id",), not_null=("customer_id",)),
    "dim_agents": Expectations(unique=("agent_id",), not_null=("agent_id",)),
    "fct_calls": Expectations(
        unique=("call_id",),
        not_null=("call_id",),
        references=(
            Reference("customer_id", "dim_customers", "customer_id"),
            Reference("agent_id", "dim_agents", "agent_id"),
        ),
    ),
    "fct_unified_complaints": Expectations(
        unique=("complaint_pk",), not_null=("complaint_pk",), accepted=(("channel", CHANNELS),)
    ),
}


@dataclass(frozen=True)
class _Test:
    """One declared test; ``fails`` tells of single rows, the others count values."""

    test: str
    table: str
    column: str
    fails: Column | None = None
    reference: Reference | None = None


def _declared(name: str, expected: Expectations) -> list[_Test]:
    rows = [_null_test(column) for column in expected.not_null]
    rows += [_value_test(column, values) for column, values in expected.accepted]
    return [
        *(_Test("unique", name, column) for column in expected.unique),
        *(_Test(test, name, column, fails) for test, column, fails in rows),
        *(_Test("relationships", name, ref.column, reference=ref) for ref in expected.references),
    ]


def run_suite(tables: Mapping[str, DataFrame], expectations: Mapping[str, Expectations]) -> DataFrame:
    """All declared tests whose table is given, as one frame. Each table is read once.

    Every row becomes what its table's tests have to count: its value under each test of uniqueness, its reference, the
    key that others refer to, and the row tests it fails. Rows of all tables are counted per (test, value) together, before
    and after one shuffle; then a test fails for values met twice, or for references whose value no parent has.
    """
    declared = [
        test for name, expected in expectations.items() if name in tables for test in _declared(name, expected)
    ]

    def entry(number: int, key: Column, parent: bool = False) -> Column:
        return F.struct(F.lit(number).alias("number"), key.alias("key"), F.lit(parent).alias("parent"))

    counted = []
    for name, df in tables.items():
        entries = []
        for number, test in enumerate(declared):
            value = F.col(test.column).cast("string")
            if test.table == name and test.fails is not None:
                entries.append(F.when(test.fails, entry(number, F.lit(None).cast("string"))))
            elif test.table == name:
                entries.append(F.when(F.col(test.column).isNotNull(), entry(number, value)))
            if test.reference is not None and test.reference.parent == name:
                parent = F.col(test.reference.parent_column)
                entries.append(F.when(parent.isNotNull(), entry(number, parent.cast("string"), True)))
        if entries:
            counted.append(df.select(F.inline(F.array_compact(F.array(*entries)))))
    if not declared:
        raise QualityError("no test is declared for any of these tables")
    per_key = _union(counted).groupBy("number", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.bool_or("parent").alias("known")
    )
    kinds = F.array(*(F.lit(test.test) for test in declared))
    kind, rows = F.get(kinds, F.col("number")), F.col("rows")
    failures = (
        F.when(kind == "unique", (rows > 1).cast("long"))
        .when(kind == "relationships", F.when(F.col("known"), 0).otherwise(rows))
        .otherwise(rows)
    )
    totals = per_key.groupBy("number").agg(F.sum(failures).alias("failures"))
    spark = totals.sparkSession
    names = spark.createDataFrame(
        [(number, test.test, test.table, test.column) for number, test in enumerate(declared)],
        "number int, test string, `table` string, column string",
    )
    found = names.join(totals, "number", "left")
    return found.select("test", "table", "column", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


def _result(test: str, table: str, column: str, one_row: DataFrame) -> DataFrame:
    return one_row.select(
        F.lit(test).alias("test"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
