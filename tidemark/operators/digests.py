"""Reconciliation of large copies by digests of key ranges.

Rows don't leave the task that reads them: each side is folded to one digest per key range, a count and four
sums over two 64-bit hashes of a row, which don't depend on the order of rows. Ranges with equal
digests hold equal rows; the others are split further, level by level, and only what still differs is
read in full and matched by key. Ranges are stretches of the key itself, so on a table that is sorted or
clustered by it their filters skip row groups (``PushedFilters``) on every level.

A level costs one scan for a sample of keys and one for the digests, and brings ``fan_out`` rows of
each side to the driver. Two different ranges have equal digests with a chance of about 2^-64 or less.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, col, cols, quote, require_columns
from tidemark.operators.keys import any_null
from tidemark.operators.ranges import Bound, literal, merged, range_of, sampled_bounds, types_of, within
from tidemark.operators.reconcile import reconcile_keys, reconcile_rows

PARTS = ("d0", "d1", "d2", "d3")
FAN_OUT = 64


class Level(NamedTuple):
    """One round: ranges compared, those that differ, and the rows on both sides before and after."""

    ranges: int
    differing: int
    rows: int
    differing_rows: int


class Narrowed(NamedTuple):
    """``where`` holds for all rows that can differ; ``equal_rows`` rows of the source have equals."""

    where: Column
    equal_rows: int
    levels: list[Level]


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row, each as two signed halves, whose sums can't overflow below 2^32 rows.

    A NULL changes no hash by itself, so it is hashed as a flag of its own.
    """
    parts = [p for c in columns for p in (col(c), col(c).isNull())]
    out = []
    for seed in (11, 29):
        h = F.xxhash64(F.lit(seed), *parts, F.lit(seed))
        out += [F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))]
    return out


def range_digests(
    df: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    bounds: Sequence[tuple[str, ...]],
) -> DataFrame:
    """``(range, n, d0 .. d3)`` of the rows with a complete key; at most ``len(bounds) + 1`` rows."""
    keys = as_list(keys)
    sums = [F.sum(h).alias(p) for h, p in zip(row_hashes(columns), PARTS, strict=True)]
    place = range_of(keys, types_of(df, keys), bounds).alias("range")
    return df.where(~any_null(keys)).groupBy(place).agg(F.count(F.lit(1)).alias("n"), *sums)


def _sorted_bounds(
    source: DataFrame, target: DataFrame, keys, types, intervals, fan_out: int
) -> list[tuple[str, ...]]:
    """Ends of the intervals and, between them, keys that split their rows evenly; sorted by Spark."""
    inside = within(keys, types, intervals) & ~any_null(keys)
    rows = source.where(inside).select(*cols(keys)).unionByName(target.where(inside).select(*cols(keys)))
    places = sampled_bounds(rows, keys, fan_out)
    edges = {b for ends in intervals for b in ends if b is not None}
    if edges:
        parts = [
            "struct(" + ", ".join(
                f"{literal(v, t)} AS {quote(k)}" for v, t, k in zip(b, types, keys, strict=True)
            ) + ")"
            for b in edges
        ]
        one = source.sparkSession.range(1).select(F.expr(f"inline(array({', '.join(parts)}))"))
        places = places.unionByName(one).distinct()
    found = places.orderBy(*cols(keys)).select(*[col(k).cast("string") for k in keys]).collect()
    return [tuple(r) for r in found]


def narrow(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str] | None = None,
    fan_out: int = FAN_OUT,
    enough: int = 1_000_000,
) -> Narrowed:
    """Where the two sides can differ in ``columns`` (by default all common ones).

    Splitting goes on while it at least halves what differs and more than ``enough`` rows (of both
    sides) are left; either way all that differs lies within ``where``. Rows with a NULL in the
    key are in no range: ``where`` is not true for them. Keys may be of any orderable type but
    binary, and repeat; sides should agree in types, else ranges differ that need not.
    """
    keys = as_list(keys)
    if columns is None:
        columns = [c for c in source.columns if c in target.columns and c not in keys]
    wanted = [*keys, *[c for c in columns if c not in keys]]
    require_columns(source.columns, wanted, "source")
    require_columns(target.columns, wanted, "target")
    source, target = source.select(*cols(wanted)), target.select(*cols(wanted))
    types = types_of(source, keys)
    intervals: list[tuple[Bound, Bound]] = [(None, None)]
    equal_rows, levels = 0, []
    while True:
        bounds = _sorted_bounds(source, target, keys, types, intervals, fan_out)
        inside = within(keys, types, intervals)
        sides = [
            range_digests(df.where(inside), keys, wanted, bounds).withColumn("side", F.lit(side))
            for side, df in enumerate((source, target))
        ]
        found: dict[int, list] = {}
        for r in reduce(DataFrame.unionByName, sides).collect():
            found.setdefault(r["range"], [None, None])[r["side"]] = (r["n"], *[r[p] for p in PARTS])
        count = {i: sum(d[0] for d in both if d) for i, both in found.items()}
        differing = [i for i, (s, t) in found.items() if s != t]
        equal_rows += sum(s[0] for s, t in found.values() if s == t)
        intervals = merged(differing, bounds)
        rows, left = sum(count.values()), sum(count[i] for i in differing)
        levels.append(Level(len(found), len(differing), rows, left))
        if left <= enough or left * 2 > rows or len(intervals) * 2 > fan_out:
            return Narrowed(within(keys, types, intervals), equal_rows, levels)


def reconcile_rows_digest(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str] | None = None,
    fan_out: int = FAN_OUT,
    enough: int = 1_000_000,
) -> DataFrame:
    """As :func:`reconcile_rows`, but only ranges that differ are read in full and shuffled.

    Keys must be unique. In ranges that differ a repeated key fails the job; a range that is equal
    on both sides isn't checked for it.
    """
    keys = as_list(keys)
    found = narrow(source, target, keys, columns, fan_out, enough)
    report = reconcile_rows(source.where(found.where), target.where(found.where), keys, columns)
    return report.withColumn("compared", F.col("compared") + F.lit(found.equal_rows))


def reconcile_keys_digest(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    fan_out: int = FAN_OUT,
    enough: int = 1_000_000,
) -> DataFrame:
    """As :func:`reconcile_keys` (NULL equals NULL), reading in full what differs, and NULL keys."""
    keys = as_list(keys)
    found = narrow(source, target, keys, (), fan_out, enough)
    where = found.where | any_null(keys)
    report = reconcile_keys(source.where(where), target.where(where), keys)
    same = F.lit(found.equal_rows)
    return report.withColumn("source_count", F.col("source_count") + same).withColumn(
        "target_count", F.col("target_count") + same
    )
