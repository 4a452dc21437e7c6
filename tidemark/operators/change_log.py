"""Change logs: what changed between two states, as rows that can be replayed.

Keys follow the set rule (NULL equals NULL), so that replaying a difference gives back
the new state whatever the keys hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import timestamp
from tidemark.functions.names import as_list, cols, require_columns
from tidemark.operators.keys import KEY, differs, latest_per_key, pair_by_key, split_null_keys

# The operations of a change log.
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"

KEEP_NULLS = {"ignoreNullFields": "false"}


def _json(row: Column) -> Column:
    return F.when(row.isNotNull(), F.to_json(row, KEEP_NULLS))


def record_id(keys: Sequence[str], row: str | None = None) -> Column:
    """The key as text: one part as it is, several joined by ``|``; NULL if any is NULL.

    Of several, ``|`` and the escape itself are escaped by ``\\`` inside a part, so different keys have
    different texts.
    """
    parts = [F.col(row)[k] if row else F.col(f"`{k}`") for k in keys]
    texts = [p.cast("string") for p in parts]
    if len(texts) == 1:
        return texts[0]
    # Only text parts can hold either sign.
    texts = [F.regexp_replace(t, r"([|\\])", r"\\$1") for t in texts]
    joined = texts[0]
    for t in texts[1:]:
        joined = F.concat(joined, F.lit("|"), t)
    return joined


def append_log(
    df: DataFrame, table: str, keys: str | Sequence[str], run_ts: object, operation: str = INSERT
) -> DataFrame:
    """One log row per row of ``df``: the row as JSON, no previous value. No shuffle."""
    keys = as_list(keys)
    require_columns(df.columns, keys, "append_log")
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(operation).alias("operation"),
        record_id(keys).alias("record_id"),
        F.lit(None).cast("string").alias("old_data"),
        _json(F.struct(*cols(df.columns))).alias("new_data"),
        timestamp(run_ts).alias("changed_at"),
    )


def diff(
    old: DataFrame,
    new: DataFrame,
    keys: str | Sequence[str],
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Changed rows only: ``operation``, ``before`` and ``after`` (whole rows as structs).

    One full outer join; values are compared NULL-safely on ``compare``, by default all
    columns the two sides share. Keys must be unique on each side.
    """
    keys = as_list(keys)
    shared = [c for c in new.columns if c in old.columns and c not in keys]
    pairs = pair_by_key(old, new, keys, nulls_match=True)
    gone, came = F.col("after").isNull(), F.col("before").isNull()
    changed = differs("before", "after", list(compare) if compare is not None else shared)
    operation = F.when(came, INSERT).when(gone, DELETE).when(changed, UPDATE)
    return pairs.select(operation.alias("operation"), "before", "after").where(
        F.col("operation").isNotNull()
    )


def to_log(
    changes: DataFrame, table: str, keys: str | Sequence[str], run_ts: object
) -> DataFrame:
    """A :func:`diff` in the stored form of a change log, rows as JSON."""
    keys = as_list(keys)
    row = F.coalesce(record_id(keys, "after"), record_id(keys, "before"))
    return changes.select(
        F.lit(table).alias("table_name"),
        F.col("operation"),
        row.alias("record_id"),
        _json(F.col("before")).alias("old_data"),
        _json(F.col("after")).alias("new_data"),
        timestamp(run_ts).alias("changed_at"),
    )


def from_log(log: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored log rows back to ``before``/``after`` structs of ``schema``.

    Numbers, dates and zone-less timestamps survive the JSON text unchanged.
    """
    return log.select(
        "*",
        F.from_json("old_data", schema).alias("before"),
        F.from_json("new_data", schema).alias("after"),
    ).drop("old_data", "new_data")


def apply_log(
    base: DataFrame, log: DataFrame, keys: str | Sequence[str], seq: str | None = None
) -> DataFrame:
    """Replay a log on ``base``: the last operation of each key wins.

    ``log`` has ``operation``, ``before``, ``after``, and ``seq`` (its order) unless each
    key occurs once. The last operation is picked before the shuffle as well, so a key
    with many changes is no hot spot.
    """
    keys = as_list(keys)
    last = log.select(
        F.struct(*(F.coalesce(F.col("after")[k], F.col("before")[k]).alias(k) for k in keys)).alias(
            KEY
        ),
        "operation",
        "after",
        *([F.col(seq).alias("__seq")] if seq else []),
    )
    if seq:
        last = latest_per_key(last, [KEY], ["__seq"])
    # Complete keys meet as columns, so that statistics, bucketing and runtime filters of the base
    # count; only keys with a NULL, which equals NULL here, are compared as structs.
    keyed, unkeyed = split_null_keys(base, keys)
    logged = last.select(*(F.col(KEY)[k].alias(k) for k in keys))
    logged_keyed, logged_unkeyed = split_null_keys(logged, keys)
    untouched = keyed.join(logged_keyed, keys, "left_anti").select(*cols(base.columns)).unionByName(
        unkeyed.withColumn(KEY, F.struct(*cols(keys)))
        .join(logged_unkeyed.select(F.struct(*cols(keys)).alias(KEY)), KEY, "left_anti")
        .select(*cols(base.columns))
    )
    rows = last.where(F.col("operation") != DELETE).select("after.*")
    return untouched.unionByName(rows.select(*cols(base.columns)))
