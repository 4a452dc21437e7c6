"""Slowly changing history (type 2): versions of rows with validity times.

Keys follow the SQL rule: a row whose key is NULL matches no earlier version, so it opens
a new one at each run and, with ``hard_deletes``, closes the previous one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import timestamp
from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.keys import (
    any_null,
    differs,
    pair_by_key,
    reject_duplicates,
    split_null_keys,
)


@dataclass(frozen=True)
class HistoryColumns:
    """Names of the bookkeeping columns; set ``prefix`` to match an existing history."""

    prefix: str = "scd_"

    @property
    def valid_from(self) -> str:
        return f"{self.prefix}valid_from"

    @property
    def valid_to(self) -> str:
        return f"{self.prefix}valid_to"

    @property
    def updated_at(self) -> str:
        return f"{self.prefix}updated_at"

    @property
    def all(self) -> list[str]:
        return [self.valid_from, self.valid_to, self.updated_at]


def composite_key(columns: Sequence[str], delimiter: str = "|") -> Column:
    """Key parts joined by ``delimiter``; NULL when any part is NULL."""
    parts: list[Column] = []
    for i, name in enumerate(columns):
        parts += [F.lit(delimiter)] if i else []
        parts.append(col(name).cast("string"))
    return F.concat(*parts)


def first_snapshot(
    source: DataFrame,
    run_ts: object = None,
    updated_at: str | None = None,
    names: HistoryColumns = HistoryColumns(),
) -> DataFrame:
    """A history with one open version per source row."""
    since = col(updated_at).cast("timestamp_ntz") if updated_at else timestamp(run_ts)
    return source.select(
        *cols(source.columns),
        since.alias(names.valid_from),
        F.lit(None).cast("timestamp_ntz").alias(names.valid_to),
        since.alias(names.updated_at),
    )


def snapshot(
    history: DataFrame | None,
    source: DataFrame,
    key: str | Sequence[str],
    strategy: str,
    run_ts: object = None,
    check_cols: Sequence[str] | None = None,
    updated_at: str | None = None,
    hard_deletes: bool = False,
    names: HistoryColumns = HistoryColumns(),
) -> DataFrame:
    """The history after one more run.

    ``check``: a key gets a new version when any of ``check_cols`` differs (NULL-safe; all
    columns by default). ``timestamp``: when ``updated_at`` is newer than the open version.
    ``hard_deletes`` closes open versions whose key is gone.

    Only open versions take part in the join; closed ones pass through untouched.
    """
    keys = as_list(key)
    require_columns(source.columns, keys, "source")
    if strategy not in ("check", "timestamp"):
        raise ValueError(f"unknown snapshot strategy: {strategy!r}")
    if strategy == "timestamp" and not updated_at:
        raise ValueError("the timestamp strategy needs updated_at")
    if (strategy == "check" or hard_deletes) and run_ts is None:
        raise ValueError("run_ts is needed to stamp versions")
    if history is None:
        return first_snapshot(source, run_ts, updated_at, names)

    data = [c for c in history.columns if c not in names.all]
    is_open = col(names.valid_to).isNull()
    pairs = pair_by_key(history.where(is_open), source, keys)

    old, new = F.col("before"), F.col("after")
    if strategy == "check":
        compared = check_cols if check_cols is not None else [c for c in data if c not in keys]
        since = timestamp(run_ts)
        changed = differs("before", "after", list(compared))
    else:
        since = new[updated_at].cast("timestamp_ntz")
        changed = since > old[names.valid_from]
    has_old, has_new = old.isNotNull(), new.isNotNull()
    changed = has_old & has_new & F.coalesce(changed, F.lit(False))
    deleted = (has_old & ~has_new) if hard_deletes else F.lit(False)
    ended = F.when(changed, since).when(deleted, timestamp(run_ts))

    have = set(source.columns)
    types = {f.name: f.dataType for f in history.schema.fields}

    def from_source(c: str) -> Column:
        return (new[c] if c in have else F.lit(None)).cast(types[c])

    kept = F.struct(
        *(old[c].alias(c) for c in data),
        old[names.valid_from].alias(names.valid_from),
        ended.cast(types[names.valid_to]).alias(names.valid_to),
        old[names.updated_at].alias(names.updated_at),
    )
    opened = F.struct(
        *(from_source(c).alias(c) for c in data),
        since.cast(types[names.valid_from]).alias(names.valid_from),
        F.lit(None).cast(types[names.valid_to]).alias(names.valid_to),
        since.cast(types[names.updated_at]).alias(names.updated_at),
    )
    versions = F.array_compact(
        F.array(F.when(has_old, kept), F.when(has_new & (~has_old | changed), opened))
    )
    after = pairs.select(F.inline(versions))
    closed = history.where(~is_open).select(*cols(after.columns))
    return closed.unionByName(after)


def next_load(loads: Sequence[object], run_ts: object) -> object | None:
    """The earliest of ``loads`` after ``run_ts``."""
    return min((t for t in loads if t > run_ts), default=None)


def splice_load(
    history: DataFrame | None,
    source: DataFrame,
    key: str | Sequence[str],
    run_ts: object,
    next_run_ts: object | None = None,
    check_cols: Sequence[str] | None = None,
    names: HistoryColumns = HistoryColumns(),
) -> DataFrame:
    """The history after a whole load of the source that was taken at ``run_ts``, however late it comes.

    As ``snapshot(..., "check", hard_deletes=True)``, but ``history`` may hold later loads already;
    ``next_run_ts`` is the first of them (:func:`next_load`), which confirmed what lasted beyond it. Loads
    spliced in any order give the history of their order in time, if all columns are checked; a column that isn't is that of the
    load that opened the version, or of the version it was cut from.

    Per key: an equal version around ``run_ts`` stays; another one ends there and, if it outlasted the next load, starts again
    at it; the load's row holds until the next load, or joins the version that starts with it
    and equals it; a key that the load lacks has a gap there. A load at a time that is known
    changes nothing that is known.

    Only versions around ``run_ts`` and those that start at ``next_run_ts`` take part, found by literal filters on the
    bookkeeping columns; all others pass through untouched. At most one of each per key meet in a
    join, so a key with many versions is no hot spot. A repeated key in the load fails the job; a NULL key matches no version.
    """
    keys = as_list(key)
    require_columns(source.columns, keys, "source")
    if run_ts is None:
        raise ValueError("run_ts is needed to stamp versions")
    if history is None:
        return first_snapshot(source, run_ts, None, names)
    at = timestamp(run_ts)
    since, until = col(names.valid_from), col(names.valid_to)
    around = (since <= at) & (until.isNull() | (until > at))
    follows = since == timestamp(next_run_ts) if next_run_ts is not None else F.lit(False)
    data = [c for c in history.columns if c not in names.all]
    types = {f.name: f.dataType for f in history.schema.fields}
    compared = list(check_cols) if check_cols is not None else [c for c in data if c not in keys]

    # NULL keys of the history equal nothing; what follows them is a version of its own.
    row = F.struct(*cols(history.columns))
    ahead = history.where(follows & ~any_null(keys)).select(
        *(col(k).alias(f"__k{i}") for i, k in enumerate(keys)), row.alias("w")
    )
    lone = history.where(follows & any_null(keys))
    pairs = pair_by_key(history.where(around), source, keys).select(
        *(F.coalesce(F.col("before")[k], F.col("after")[k]).alias(f"__k{i}") for i, k in enumerate(keys)),
        "before", "after",
    )
    pairs = pairs.join(ahead, [f"__k{i}" for i in range(len(keys))], "full")

    v, r, w = F.col("before"), F.col("after"), F.col("w")
    has_v, has_r, has_w = v.isNotNull(), r.isNotNull(), w.isNotNull()
    same_v = has_v & has_r & ~differs("before", "after", compared)
    known = has_v & (v[names.valid_from] == at)
    have = set(source.columns)

    def version(values: Column, start: Column, end: Column, loaded: bool = False) -> Column:
        def of(c: str) -> Column:
            return (F.lit(None) if loaded and c not in have else values[c]).cast(types[c]).alias(c)

        stamps = {names.valid_from: start, names.valid_to: end, names.updated_at: start}
        return F.struct(
            *(stamps[c].cast(types[c]).alias(c) if c in stamps else of(c) for c in history.columns)
        )

    ahead_at = timestamp(next_run_ts) if next_run_ts is not None else F.lit(None).cast("timestamp_ntz")
    lasts = v[names.valid_to].isNull() | (v[names.valid_to] > ahead_at)
    cut = has_v & ~known & ~same_v
    same_w = has_r & has_w & ~differs("after", "w", compared)
    opens = has_r & ~known & ~same_v
    versions = F.array_compact(
        F.array(
            F.when(has_v & ~cut, v),
            F.when(cut, version(v, v[names.valid_from], at)),
            # What the next load confirmed starts again with it.
            F.when(cut & ahead_at.isNotNull() & lasts, version(v, ahead_at, v[names.valid_to])),
            F.when(opens & ~same_w, version(r, at, ahead_at, loaded=True)),
            F.when(opens & same_w, version(r, at, w[names.valid_to], loaded=True)),
            F.when(has_w & ~(opens & same_w), w),
        )
    )
    rest = history.where(~F.coalesce(around | follows, F.lit(False)))
    return rest.unionByName(lone).unionByName(pairs.select(F.inline(versions)))


def splice_rows(
    history: DataFrame | None,
    rows: DataFrame,
    key: str | Sequence[str],
    updated_at: str,
    names: HistoryColumns = HistoryColumns(),
) -> DataFrame:
    """The history after rows that changed at their ``updated_at``, however late they come.

    As ``snapshot(..., "timestamp")``, but a row older than its key's open version is put where it
    belongs: it ends the version around its time and lasts to where that ended, or to the next version. Rows
    spliced in any order give one history. A key's version of the same time stays as it is. A
    repeated key among ``rows`` and a NULL time fail the job; a NULL key matches no version, so it opens one.

    The history is joined with the rows twice, never shuffled for a small load, and no key's
    versions are gathered: neighbours are minima and maxima per key.
    """
    keys = as_list(key)
    require_columns(rows.columns, [*keys, updated_at], "rows")
    time = F.coalesce(
        col(updated_at).cast("timestamp_ntz"),
        F.raise_error(F.lit(f"{updated_at} is NULL")).cast("timestamp_ntz"),
    )
    if history is None:
        history = first_snapshot(rows.limit(0), None, updated_at, names)
    keyed, unkeyed = split_null_keys(rows, keys)
    keyed = reject_duplicates(keyed, keys, "rows")
    types = {f.name: f.dataType for f in history.schema.fields}
    at, since, until = F.col("__at"), col(names.valid_from), col(names.valid_to)
    times = keyed.select(*cols(keys), time.alias("__at"))
    inside = (since < at) & (until.isNull() | (until > at))
    near = history.select(*cols(keys), since, until).join(times, keys)
    cuts = near.groupBy(*cols(keys)).agg(
        F.bool_or(since == at).alias("__known"),
        F.min(F.when(since > at, since)).alias("__next"),
        # A struct, as an open version's end is NULL.
        F.max(F.when(inside, F.struct(until.alias("to")))).alias("__inside"),
    )
    placed = keyed.withColumn("__at", time).join(cuts, keys, "left")
    end = F.when(F.col("__inside").isNotNull(), F.col("__inside.to")).otherwise(F.col("__next"))
    fresh = placed.where(~F.coalesce(F.col("__known"), F.lit(False))).withColumn("__end", end)
    alone = unkeyed.withColumn("__at", time).withColumn("__end", F.lit(None).cast("timestamp_ntz"))
    have = set(rows.columns)

    def opened(df: DataFrame) -> DataFrame:
        stamps = {names.valid_from: at, names.valid_to: F.col("__end"), names.updated_at: at}
        return df.select(
            *(
                (stamps[c] if c in stamps else col(c) if c in have else F.lit(None)).cast(types[c]).alias(c)
                for c in history.columns
            )
        )

    own, none = split_null_keys(history, keys)
    marks = times.select(*(col(k).alias(f"__k{i}") for i, k in enumerate(keys)), "__at")
    match = reduce(lambda a, b: a & b, (col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)))
    cut = own.join(marks, match & inside, "left").select(
        *(
            (F.coalesce(at.cast(types[c]), col(c)).alias(c) if c == names.valid_to else col(c))
            for c in history.columns
        )
    )
    return cut.unionByName(none).unionByName(opened(fresh)).unionByName(opened(alone))


def as_of(
    history: DataFrame, t: object, names: HistoryColumns = HistoryColumns()
) -> DataFrame:
    """The source's state at time ``t``; the bookkeeping columns are dropped."""
    at = timestamp(t)
    valid = (col(names.valid_from) <= at) & (
        col(names.valid_to).isNull() | (col(names.valid_to) > at)
    )
    return history.where(valid).drop(*names.all)


def history_of(
    history: DataFrame,
    key: str | Sequence[str],
    only: Column | str | None = None,
    names: HistoryColumns = HistoryColumns(),
) -> DataFrame:
    """All versions in order: by key, then by start. ``only`` filters to some keys."""
    df = history if only is None else history.where(only)
    return df.orderBy(*cols(as_list(key)), col(names.valid_from))


def history_gaps(
    history: DataFrame, key: str | Sequence[str], names: HistoryColumns = HistoryColumns()
) -> DataFrame:
    """Closed versions that no later version of the key continues: deletions or gaps.

    An anti join on (key, end = start), which spreads a key with many versions; a window
    over the key would put them all into one task.
    """
    keys = as_list(key)
    starts = history.select(*cols(keys), col(names.valid_from).alias(names.valid_to))
    ended = history.where(col(names.valid_to).isNotNull())
    return ended.join(starts, [*keys, names.valid_to], "left_anti").select(*cols(history.columns))
