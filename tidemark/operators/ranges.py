"""Ranges of keys: between which bounds a key lies, and filters that reach the files.

A bound is the texts of a key's parts. Ranges are half open, from a bound up to but without the next one; keys with a NULL
are in none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import cols, quote

# A place between keys: the texts of its parts, None for the open end.
Bound = tuple[str, ...] | None
# A sampled bound is picked out of so many keys.
OVERSAMPLE = 16


def types_of(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [df.schema[k].dataType.simpleString() for k in keys]


# Range tests are built as SQL text: some hundred nested columns would cost a call to the JVM each.
def literal(value: str, dtype: str) -> str:
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {dtype})"


def before(keys: Sequence[str], types: Sequence[str], bound: tuple[str, ...]) -> str:
    """The key lies below a bound, part by part."""
    k, b = quote(keys[0]), literal(bound[0], types[0])
    if len(keys) == 1:
        return f"{k} < {b}"
    return f"({k} < {b} OR ({k} = {b} AND {before(keys[1:], types[1:], bound[1:])}))"


def between(keys: Sequence[str], types: Sequence[str], low: Bound, high: Bound) -> str:
    """low <= key < high; the bare first part goes along, as files keep statistics of it."""
    tests, first = [], quote(keys[0])
    if low is not None:
        tests.append(f"{first} >= {literal(low[0], types[0])}")
        if len(keys) > 1:
            tests.append(f"NOT {before(keys, types, low)}")
    if high is not None:
        if len(keys) > 1:
            tests.append(f"{first} <= {literal(high[0], types[0])}")
        tests.append(before(keys, types, high))
    return " AND ".join(tests) or "true"


def within(keys, types, intervals: Sequence[tuple[Bound, Bound]]) -> Column:
    tests = [f"({between(keys, types, low, high)})" for low, high in intervals]
    return F.expr(" OR ".join(tests) or "false")


def range_of(keys: Sequence[str], types: Sequence[str], bounds: Sequence[tuple[str, ...]]) -> Column:
    """Number of bounds at or below the key, by halving."""

    def among(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        left, right = among(low, mid), among(mid + 1, high)
        return f"CASE WHEN {before(keys, types, bounds[mid])} THEN {left} ELSE {right} END"

    return F.expr(among(0, len(bounds)))


def sampled_bounds(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` keys, in no order, that split ``rows`` into ranges of about equal size.

    Every ``OVERSAMPLE``-th key of a uniform sample of rows: a frequent key takes a large part of
    the sample but is one bound. Keys are of any orderable type; one task ranks the sample, which is bounded.
    """
    some = rows.orderBy(F.rand(7)).limit(n * OVERSAMPLE)
    w = Window.orderBy(*cols(keys))
    return (
        some.groupBy(*cols(keys)).count()
        .withColumn("__upto", F.sum("count").over(w) - F.col("count"))
        .withColumn("__step", F.floor(F.col("__upto") / OVERSAMPLE))
        .groupBy("__step").agg(F.min(F.struct(*cols(keys))).alias("__k"))
        .select("__k.*")
    )


def merged(numbers: Sequence[int], bounds: Sequence[tuple[str, ...]]) -> list[tuple[Bound, Bound]]:
    """Neighbouring ranges as one interval."""
    out: list[list[int]] = []
    for i in sorted(numbers):
        if out and out[-1][1] == i:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1])
    ends = [None, *bounds, None]
    return [(ends[a], ends[b]) for a, b in out]
