"""Merges: (target, stage, keys) -> the next target, as one declared plan.

NULL keys follow the SQL rule: they match nothing, so staged ones are inserted and
target ones are left alone (or deleted by a full sync).

The target is the big side. Where it only has to lose or keep rows it is joined with the
staged keys alone, and it is not shuffled when those are small enough for Spark to
broadcast by its own size limit (stage the delta as a table first, so that Spark knows
its size; see ``tidemark.plans.sync``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import timestamp
from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.keys import (
    differs,
    pair_by_key,
    resolve_duplicates,
    split_null_keys,
)

# Columns a versioned merge never overwrites in a matched row.
KEPT_ON_UPDATE = ("created_at", "id")
UPDATED_AT = "updated_at"

PRESENT = "__staged"
STAGED = "__stage"
HELD = "__held"


def _without(target: DataFrame, staged_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not staged."""
    keyed, unkeyed = split_null_keys(target, keys)
    staged_keys, _ = split_null_keys(staged_keys, keys)
    kept = keyed.join(staged_keys, list(keys), "left_anti").select(*cols(target.columns))
    return kept.unionByName(unkeyed)


def _new_rows(
    target: DataFrame, stage: DataFrame, staged_keys: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Staged rows whose key the target does not have.

    First the staged keys found in the target, which is at most as many as there are
    staged keys, then the staged rows without them: with a small stage the target's key
    column is only scanned, never shuffled.
    """
    keyed, unkeyed = split_null_keys(stage, keys)
    target_keys, _ = split_null_keys(target.select(*cols(keys)), keys)
    staged_keys, _ = split_null_keys(staged_keys, keys)
    found = target_keys.join(staged_keys, list(keys), "left_semi")
    fresh = keyed.join(found, list(keys), "left_anti").select(*cols(stage.columns))
    return fresh.unionByName(unkeyed)


def not_older(
    stage: DataFrame, target: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Staged rows without those that are older, by ``order_by``, than the target's row.

    Makes an upsert independent of the order in which deltas arrive. Only the target's
    keys and order columns are read, and rows found there are at most as many as staged.
    """
    keyed, unkeyed = split_null_keys(stage, keys)
    known, _ = split_null_keys(target.select(*cols(dict.fromkeys([*keys, *order_by]))), keys)
    held = known.join(keyed.select(*cols(keys)), list(keys), "left_semi").select(
        *cols(keys), F.struct(*cols(order_by)).alias(HELD)
    )
    current = F.col(HELD).isNull() | (F.struct(*cols(order_by)) >= F.col(HELD))
    kept = keyed.join(held, list(keys), "left").where(current).select(*cols(stage.columns))
    return kept.unionByName(unkeyed)


def _shaped(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with exactly the columns of ``like``: by name, missing ones NULL."""
    have = set(df.columns)
    return df.select(
        *(
            col(f.name).cast(f.dataType) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        )
    )


def delete_insert(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    staged_keys: DataFrame | None = None,
) -> DataFrame:
    """Delete target rows whose key is staged, insert every staged row.

    ``staged_keys`` may name the keys more cheaply than ``stage`` does, such as before
    duplicates were resolved; repeats in it do not matter.
    """
    if staged_keys is None:
        staged_keys = stage.select(*cols(keys))
    return _without(target, staged_keys, keys).unionByName(_shaped(stage, target))


def insert_ignore(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    staged_keys: DataFrame | None = None,
) -> DataFrame:
    """Insert staged rows with new keys; existing rows stay as they are."""
    if staged_keys is None:
        staged_keys = stage.select(*cols(keys))
    return target.unionByName(_shaped(_new_rows(target, stage, staged_keys, keys), target))


def full_sync(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matched, insert new, delete target rows that are not staged.

    The stage is the result; only columns that the stage lacks are looked up.
    """
    only = [c for c in target.columns if c not in stage.columns]
    if not only:
        return _shaped(stage, target)
    keyed, unkeyed = split_null_keys(stage, keys)
    carried, _ = split_null_keys(target.select(*cols([*keys, *only])), keys)
    joined = keyed.join(carried, list(keys), "left")
    return _shaped(joined, target).unionByName(_shaped(unkeyed, target))


def upsert(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, str | Column] | None = None,
    staged_keys: DataFrame | None = None,
) -> DataFrame:
    """Insert new keys, update matched ones.

    ``rules`` says per column what a matched row gets: ``"source"`` (the default),
    ``"target"`` (left as it is) or a Column to set. Columns that the stage lacks keep the
    target's value.
    """
    rules = dict(rules or {})
    only = [c for c in target.columns if c not in stage.columns]
    if staged_keys is None:
        staged_keys = stage.select(*cols(keys))
    plain = not only and all(isinstance(r, str) and r == "source" for r in rules.values())
    if plain:
        return delete_insert(target, stage, keys, staged_keys)

    keyed, _ = split_null_keys(stage, keys)
    rows = keyed.select(
        *cols(keys), F.struct(*cols(stage.columns)).alias(STAGED), F.lit(True).alias(PRESENT)
    )
    present = F.coalesce(F.col(PRESENT), F.lit(False))

    def pick(name: str) -> Column:
        rule = rules.get(name, "source")
        if name in keys:
            return col(name)
        if isinstance(rule, Column):
            matched = rule.cast(target.schema[name].dataType)
        elif rule == "target" or name in only:
            return col(name)
        elif rule == "source":
            matched = F.col(STAGED)[name].cast(target.schema[name].dataType)
        else:
            raise ValueError(f"rule for {name!r} must be 'source', 'target' or a Column")
        return F.when(present, matched).otherwise(col(name)).alias(name)

    known, unknown = split_null_keys(target, keys)
    updated = known.join(rows, list(keys), "left").select(*(pick(c) for c in target.columns))
    inserted = _shaped(_new_rows(target, stage, staged_keys, keys), target)
    return updated.unionByName(unknown).unionByName(inserted)


def _with_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def incremental(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    run_ts: object,
    staged_keys: DataFrame | None = None,
) -> DataFrame:
    """Upsert that also stamps matched rows with ``updated_at = run_ts``."""
    target = _with_column(target, UPDATED_AT, "timestamp_ntz")
    return upsert(target, stage, keys, {UPDATED_AT: timestamp(run_ts)}, staged_keys)


def versioned(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    run_ts: object,
    version: str = "source_version",
    staged_keys: DataFrame | None = None,
) -> DataFrame:
    """Upsert that carries the row version and never touches ``created_at`` and ``id``."""
    require_columns(stage.columns, [version], "stage")
    target = _with_column(target, version, stage.schema[version].dataType.simpleString())
    target = _with_column(target, UPDATED_AT, "timestamp_ntz")
    kept = {c: "target" for c in KEPT_ON_UPDATE if c in target.columns}
    rules = {**kept, UPDATED_AT: timestamp(run_ts)}
    return upsert(target, stage, keys, rules, staged_keys)


def merge(
    target: DataFrame,
    stage: DataFrame,
    keys: str | Sequence[str],
    mode: str,
    on_duplicate: str = "error",
    order_by: str | Sequence[str] = (),
    run_ts: object = None,
    rules: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """The next target under ``mode``: ``delete_insert``, ``insert_ignore``, ``upsert``,
    ``full_sync``, ``incremental`` or ``versioned``.

    Columns are matched by name. Staged columns the target does not have are dropped.
    Repeated staged keys can only be kept where rows are not updated one by one.
    """
    keys = as_list(keys)
    require_columns(target.columns, keys, "target")
    require_columns(stage.columns, keys, "stage")
    if on_duplicate == "keep" and mode not in ("delete_insert", "insert_ignore"):
        raise ValueError(f"mode {mode!r} cannot keep repeated keys")
    if mode in ("incremental", "versioned") and run_ts is None:
        raise ValueError(f"mode {mode!r} needs run_ts")
    staged_keys = stage.select(*cols(keys))
    stage = resolve_duplicates(stage, keys, on_duplicate, as_list(order_by))
    if mode == "delete_insert":
        return delete_insert(target, stage, keys, staged_keys)
    if mode == "insert_ignore":
        return insert_ignore(target, stage, keys, staged_keys)
    if mode == "full_sync":
        return full_sync(target, stage, keys)
    if mode == "upsert":
        return upsert(target, stage, keys, rules, staged_keys)
    if mode == "incremental":
        return incremental(target, stage, keys, run_ts, staged_keys)
    if mode == "versioned":
        return versioned(target, stage, keys, run_ts, staged_keys=staged_keys)
    raise ValueError(f"unknown merge mode: {mode!r}")


def merge_stats(target: DataFrame, stage: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row of counts for merging ``stage`` into ``target``.

    ``staged``, ``before``, ``after`` (of an upsert) and ``merged = after - before``;
    ``inserted``, ``updated`` (a shared value changes), ``unchanged``, ``not_staged``.
    """
    keys = as_list(keys)
    shared = [c for c in target.columns if c in stage.columns]
    pairs = pair_by_key(target.select(*cols(shared)), stage.select(*cols(shared)), keys)
    old, new = F.col("before").isNotNull(), F.col("after").isNotNull()
    changed = differs("before", "after", [c for c in shared if c not in keys])
    return pairs.agg(
        F.count_if(new).alias("staged"),
        F.count_if(old).alias("before"),
        F.count_if(new & ~old).alias("inserted"),
        F.count_if(new & old & changed).alias("updated"),
        F.count_if(new & old & ~changed).alias("unchanged"),
        F.count_if(old & ~new).alias("not_staged"),
        F.count(F.lit(1)).alias("after"),
        F.count_if(new & ~old).alias("merged"),
    )
