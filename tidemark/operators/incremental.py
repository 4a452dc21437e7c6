"""Incremental extraction: predicates, high-water marks, row versions.

A high-water mark is one value. It is looked up with one aggregate and then used as a
literal, so the filter reaches the file statistics or the JDBC source; joining it in as a
table would not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import typed
from tidemark.functions.names import col, require_columns
from tidemark.spec import FIELD_KINDS

# Kinds with day precision re-read the last day.
DAY_KINDS = ("yyyymmdd", "date")


def _as_column(p: str | Column) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def predicate(
    custom: str | Column | None = None,
    base: str | Column | None = None,
    incremental: str | Column | None = None,
    combine: str = "exclusive",
) -> Column:
    """One row filter out of up to three.

    ``exclusive``: a custom filter replaces the incremental one. ``and``: all that are
    given must hold. With none, every row passes.
    """
    if combine not in ("exclusive", "and"):
        raise ValueError(f"combine must be 'exclusive' or 'and', not {combine!r}")
    if combine == "exclusive" and custom is not None:
        incremental = None
    given = [_as_column(p) for p in (custom, incremental, base) if p is not None]
    return reduce(lambda a, b: a & b, given) if given else F.lit(True)


def split_part_in(name: str, delimiter: str, part: int, values: Sequence[str]) -> Column:
    """Part ``part`` (from 1) of a delimited text is one of ``values``."""
    return F.split_part(col(name), F.lit(delimiter), F.lit(part)).isin(list(values))


def like_not_in(
    name: str, pattern: str, excluded_column: str, excluded: Sequence[str]
) -> Column:
    """``name LIKE pattern AND excluded_column NOT IN excluded``; a NULL there drops the row."""
    return col(name).like(pattern) & ~col(excluded_column).isin(list(excluded))


def watermark(target: DataFrame, field: str) -> DataFrame:
    """One row: the highest ``field`` of the target, NULL when there is none."""
    require_columns(target.columns, [field], "watermark")
    return target.agg(F.max(col(field)).alias("hwm"))


def watermark_value(target: DataFrame | None, field: str) -> str | None:
    """The watermark as text, None for an absent or empty target.

    Text survives the way to the driver and back unchanged, whatever the type and zone.
    """
    if target is None:
        return None
    return watermark(target, field).select(F.col("hwm").cast("string")).first()[0]


def incremental_filter(
    df: DataFrame,
    field: str,
    kind: str = "default",
    hwm: str | int | None = None,
    inclusive: bool | None = None,
    lag: str | int | None = None,
) -> Column:
    """Rows of ``df`` beyond the watermark.

    Day-precision kinds compare with ``>=``, the others with ``>``; ``inclusive`` overrides
    that. ``lag`` moves the mark back to catch late rows: an interval such as ``"2 days"``,
    or a number for numeric fields. Pair it with an upsert, which absorbs the repeats.
    Without a watermark every row passes.
    """
    if kind not in FIELD_KINDS:
        raise ValueError(f"unknown incremental type: {kind!r}")
    require_columns(df.columns, [field], "incremental")
    if hwm is None:
        return F.lit(True)
    dtype = df.schema[field].dataType
    mark = typed(hwm, dtype)
    if lag is not None:
        back = F.expr(f"INTERVAL {lag}") if isinstance(lag, str) else F.lit(lag)
        mark = (mark - back).cast(dtype)
    inclusive = kind in DAY_KINDS if inclusive is None else inclusive
    return col(field) >= mark if inclusive else col(field) > mark


def incremental(
    df: DataFrame,
    field: str,
    kind: str = "default",
    hwm: str | int | None = None,
    inclusive: bool | None = None,
    lag: str | int | None = None,
) -> DataFrame:
    """``df`` beyond the watermark; see :func:`incremental_filter`."""
    return df.where(incremental_filter(df, field, kind, hwm, inclusive, lag))


def incremental_version(
    df: DataFrame,
    version: str,
    last: int | None,
    custom: str | Column | None = None,
    keep_as: str = "source_version",
) -> DataFrame:
    """Rows with a newer row version, which is kept as ``keep_as``; ``custom`` must hold too.

    Without a last version every row passes.
    """
    require_columns(df.columns, [version], "incremental_version")
    beyond = None if last is None else col(version) > F.lit(last)
    newer = predicate(custom, None, beyond, combine="and")
    return df.where(newer).withColumn(keep_as, col(version))


def version_mode(df: DataFrame, version: str, limit: int | None = None) -> DataFrame:
    """One row: highest version (0 without rows), range, and the mode to use.

    ``full_sync`` once the range of versions reaches ``limit``, if there is one; ``incremental_timestamp``
    when no row has a version; else ``incremental_version``.
    """
    v = col(version)
    return (
        df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
        .select(
            F.coalesce(F.col("hi"), F.lit(0)).alias("last_version"),
            F.coalesce(F.col("hi") - F.col("lo"), F.lit(0)).alias("version_range"),
            F.when(F.col("hi").isNull(), "incremental_timestamp")
            .when(F.lit(limit is not None) & (F.col("hi") - F.col("lo") >= (limit or 0)), "full_sync")
            .otherwise("incremental_version")
            .alias("mode"),
        )
    )
