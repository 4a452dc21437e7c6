"""Data tests: each returns its failures, a suite returns one row per test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.shape import unpivot_counts


@dataclass(frozen=True)
class DataTest:
    """``kind`` is ``unique``, ``not_null`` or ``relationship`` (to ``to_table.to_column``)."""

    table: str
    column: str
    kind: str
    to_table: str | None = None
    to_column: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("unique", "not_null", "relationship"):
            raise ValueError(f"unknown test: {self.kind!r}")
        if self.kind == "relationship" and not (self.to_table and self.to_column):
            raise ValueError("a relationship test needs to_table and to_column")


def test_unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are ignored."""
    columns = as_list(columns)
    return (
        df.select(*cols(columns))
        .dropna()
        .groupBy(*cols(columns))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def test_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: how many rows hold NULL. One aggregation for all columns."""
    require_columns(df.columns, columns, "test_not_null")
    counts = df.agg(
        *(F.count_if(col(c).isNull()).alias(f"{i}_failures") for i, c in enumerate(columns))
    )
    return unpivot_counts(counts, columns, ["failures"])


def test_relationship(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child values without a parent row: value and how many child rows hold it.

    Children are counted per value first, so the join sees each value once and a value
    that most rows share is no hot spot. NULLs are ignored.
    """
    values = (
        child.where(col(child_key).isNotNull())
        .groupBy(col(child_key).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.select(col(parent_key).alias("value"))
    return values.join(parents, "value", "left_anti").select("value", "n")


# These are library functions, not pytest cases.
test_unique.__test__ = False
test_not_null.__test__ = False
test_relationship.__test__ = False


def _result(df: DataFrame, t: DataTest) -> DataFrame:
    return df.select(
        F.lit(t.table).alias("table_name"),
        F.lit(t.column).alias("column_name"),
        F.lit(t.kind).alias("test"),
        F.col("failures"),
    )


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """One row per test: table, column, test, failures, status.

    All not-null tests of a table share one scan; unique and relationship tests read
    only their own column.
    """
    parts: list[DataFrame] = []
    for table in dict.fromkeys(t.table for t in tests):
        columns = list(
            dict.fromkeys(t.column for t in tests if t.table == table and t.kind == "not_null")
        )
        if columns:
            parts.append(
                test_not_null(tables[table], columns).select(
                    F.lit(table).alias("table_name"),
                    "column_name",
                    F.lit("not_null").alias("test"),
                    "failures",
                )
            )
    for t in tests:
        if t.kind == "unique":
            found = test_unique(tables[t.table], t.column)
        elif t.kind == "relationship":
            found = test_relationship(
                tables[t.table], t.column, tables[t.to_table], t.to_column
            )
        else:
            continue
        parts.append(_result(found.agg(F.count(F.lit(1)).alias("failures")), t))
    if not parts:
        raise ValueError("no tests given")
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )
