"""Keyed rows: duplicates, NULL keys, and matching two tables row by row.

Two rules for NULL keys are in use and every function says which one it follows:
*SQL rule* - a NULL key equals nothing, as in a merge; *set rule* - NULL equals NULL, as
in set differences and change logs.

Under the SQL rule rows with a NULL key never enter a shuffle: they would all hash to
one partition, however many there are. They are split off by a filter, which on Parquet
skips every row group whose statistics show no NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, col, cols, require_columns

ROW = "__row"
KEY = "__key"
RANK = "__rank"


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (col(k).isNull() for k in keys))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows with a NULL in the key)."""
    return df.where(~any_null(keys)), df.where(any_null(keys))


def newest_first(order_by: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """A total order: ``order_by`` descending, then every other column as tie-break.

    With a total order "the latest row" does not depend on how rows were partitioned.
    """
    rest = [c for c in columns if c not in order_by]
    return [col(c).desc_nulls_last() for c in [*order_by, *rest]]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key (set rule): the latest by ``order_by``.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each task
    sends on at most one row per key and a hot key costs no more than any other.
    """
    w = Window.partitionBy(*cols(keys)).orderBy(*newest_first(order_by, df.columns))
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) == 1).drop(RANK)


def reject_duplicates(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The same rows; the job fails when a key occurs twice (set rule).

    A running row number over the key, so it shares the shuffle and sort of a join or
    aggregation on the same key and stops at the first repeat.
    """
    w = Window.partitionBy(*cols(keys)).orderBy(*cols(keys))
    message = F.concat(
        F.lit(f"{what}: duplicate key "), F.to_json(F.struct(*cols(keys)))
    )
    once = F.when(F.col(RANK) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn(RANK, F.row_number().over(w)).where(once).drop(RANK)


def dedupe(
    df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str] = ()
) -> DataFrame:
    """Keep the latest row of each key; rows with a NULL key are all kept (SQL rule)."""
    keys, order_by = as_list(keys), as_list(order_by)
    require_columns(df.columns, [*keys, *order_by], "dedupe")
    keyed, unkeyed = split_null_keys(df, keys)
    return latest_per_key(keyed, keys, order_by).unionByName(unkeyed)


def resolve_duplicates(
    stage: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Apply the policy for keys that are staged twice: fail, keep the latest, keep all.

    ``unique`` does nothing either: the caller vouches that no key repeats.
    """
    if on_duplicate in ("keep", "unique"):
        return stage
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        return dedupe(stage, keys, order_by)
    if on_duplicate == "error":
        keyed, unkeyed = split_null_keys(stage, keys)
        return reject_duplicates(keyed, keys, "stage").unionByName(unkeyed)
    raise ValueError(f"unknown duplicate policy: {on_duplicate!r}")


def key_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that break a primary key: repeated ones and ones holding a NULL.

    Columns: the key, ``n`` rows, ``reason`` (``duplicate`` or ``null``). Counts are
    combined before the shuffle.
    """
    keys = as_list(keys)
    require_columns(df.columns, keys, "key_violations")
    return (
        df.groupBy(*cols(keys))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "reason",
            F.when(any_null(keys), F.lit("null")).when(F.col("n") > 1, F.lit("duplicate")),
        )
        .where(F.col("reason").isNotNull())
    )


def _packed(df: DataFrame, name: str) -> Column:
    return F.struct(*cols(df.columns)).alias(name)


def pair_by_key(
    before: DataFrame,
    after: DataFrame,
    keys: str | Sequence[str],
    nulls_match: bool = False,
) -> DataFrame:
    """Match two tables: columns ``before`` and ``after``, whole rows as structs.

    One full outer join. A side that has no such key is NULL. Keys must be unique on each
    side: a repeat fails the job rather than multiplying rows. ``nulls_match`` selects the
    set rule; otherwise rows with a NULL key stay alone on their side.
    """
    keys = as_list(keys)
    require_columns(before.columns, keys, "before")
    require_columns(after.columns, keys, "after")
    if nulls_match:
        # A struct is never NULL itself and compares its NULL fields as equal.
        key = F.struct(*cols(keys)).alias(KEY)
        left = reject_duplicates(before.select(key, _packed(before, "before")), [KEY], "before")
        right = reject_duplicates(after.select(key, _packed(after, "after")), [KEY], "after")
        return left.join(right, KEY, "full").select("before", "after")

    names = [f"{KEY}{i}" for i in range(len(keys))]

    def keyed(df: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        some, none = split_null_keys(df, keys)
        some = some.select(
            *(col(k).alias(n) for k, n in zip(keys, names, strict=True)), _packed(some, side)
        )
        return reject_duplicates(some, names, side), none.select(_packed(none, side))

    left, left_alone = keyed(before, "before")
    right, right_alone = keyed(after, "after")
    return (
        left.join(right, names, "full")
        .select("before", "after")
        .unionByName(left_alone, allowMissingColumns=True)
        .unionByName(right_alone, allowMissingColumns=True)
    )


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """True when any of ``columns`` differs between two struct columns, NULL-safely."""
    if not columns:
        return F.lit(False)
    same = (
        F.col(left)[c].eqNullSafe(F.col(right)[c]) for c in columns
    )
    return ~reduce(lambda a, b: a & b, same)
