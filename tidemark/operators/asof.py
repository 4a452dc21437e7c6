"""As-of joins: each row meets the last version of its key at or before its own time.

Time is cut into buckets that hold equally many rows. Rows and versions of one (key, bucket) are put in order
together, and the last version so far is carried along; what holds at the start of a bucket is the last version of
the buckets before it, one row per key and bucket. So there is no range join, no pair of a row and a version that isn't its
own, and a key with a third of all rows is spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.keys import any_null
from tidemark.operators.ranges import range_of
from tidemark.operators.sketches import ordinal_of

BUCKETS = 256


def _bounds(rows: DataFrame, buckets: int) -> list[tuple[str, ...]]:
    """Values of ``__tick`` that cut ``rows`` into buckets of about one size; ``buckets`` at most."""
    points = [k / buckets for k in range(1, buckets)]
    if not points:
        return []
    found = rows.agg(F.percentile_approx("__tick", points).alias("p")).first()["p"] or []
    return [(repr(x),) for x in sorted(set(found))]


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str | Sequence[str],
    at: str,
    since: str,
    until: str | None = None,
    prefix: str = "",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``rows`` with the columns of the last version of their key that starts at or before ``at``.

    ``versions`` have the same ``key`` columns and start at ``since``; with ``until`` a version that has
    ended by then (``until <= at``) doesn't hold. Columns of versions other than the key are added as ``prefix`` + name;
    clashing names are an error. Every row stays, once: where no version holds, where the key or the time is NULL, the
    added columns are NULL. Of versions of one key and start the greatest, column by column, holds. Versions without a key or start never
    do. ``at`` and ``since`` are of one type: a number, a date or a time.
    """
    keys = as_list(key)
    require_columns(rows.columns, [*keys, at], "rows")
    require_columns(versions.columns, [*keys, since, *([until] if until else [])], "versions")
    added = [c for c in versions.columns if c not in keys]
    clash = [prefix + c for c in added if prefix + c in rows.columns]
    if clash:
        raise ValueError(f"rows have columns {clash} already; use a prefix")
    types = rows.schema[at].dataType, versions.schema[since].dataType
    numbers = ordinal_of(at, types[0]), ordinal_of(since, types[1])
    if types[0] != types[1] or numbers[0] is None:
        raise TypeError(f"can't compare {at} ({types[0].simpleString()}) with {since} ({types[1].simpleString()})")
    kind = numbers[0][0]

    names = [f"__k{i}" for i in range(len(keys))]
    held = F.struct(*cols(added)).alias("__version")
    row = F.struct(*cols(rows.columns)).alias("__row")
    complete = ~any_null(keys) & col(at).isNotNull()
    key_of = [col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    left = rows.where(complete).select(*key_of, numbers[0][1].alias("__tick"), row)
    right = versions.where(~any_null(keys) & col(since).isNotNull()).select(
        *key_of, numbers[1][1].alias("__tick"), held
    )
    # NaN sorts last, behind all bounds.
    if kind == "double":
        left, right = (df.withColumn("__tick", F.coalesce("__tick", F.lit(float("nan")))) for df in (left, right))
    bucket = range_of(["__tick"], [kind], _bounds(left, buckets)).alias("__bucket")
    left, right = (df.select("*", bucket) for df in (left, right))

    # What holds when a bucket starts: of the buckets with a version or a row of the key, the last
    # version of those before. At most ``buckets`` rows per key.
    slots = [*names, "__bucket"]
    last = right.groupBy(*slots).agg(F.max(F.struct("__tick", "__version")).alias("__last"))
    asked = left.select(*slots, F.lit(None).cast(last.schema["__last"].dataType).alias("__last")).distinct()
    w = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    both = last.unionByName(asked).groupBy(*slots).agg(F.max("__last").alias("__last"))
    start = both.select(
        *slots, F.lit(None).cast(left.schema["__row"].dataType).alias("__row"), F.lit(None).cast(kind).alias("__tick"),
        F.last("__last", ignorenulls=True).over(w)["__version"].alias("__version"),
    ).where("__version IS NOT NULL")

    # In a bucket: what holds at its start, then versions before rows of the same time.
    no_row = F.lit(None).cast(left.schema["__row"].dataType).alias("__row")
    no_version = F.lit(None).cast(right.schema["__version"].dataType).alias("__version")
    line = (
        start.withColumn("__turn", F.lit(0))
        .unionByName(right.select(*slots, "__tick", no_row, "__version").withColumn("__turn", F.lit(1)))
        .unionByName(left.select(*slots, "__tick", "__row", no_version).withColumn("__turn", F.lit(2)))
    )
    order = Window.partitionBy(*slots).orderBy(
        F.col("__tick").asc_nulls_first(), "__turn", F.col("__version").asc_nulls_first()
    )
    found = line.withColumn(
        "__version", F.last("__version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).where(F.col("__turn") == 2)
    if until:
        ended = F.col("__version")[until] <= F.col("__row")[at]
        found = found.withColumn("__version", F.when(~F.coalesce(ended, F.lit(False)), F.col("__version")))
    out = [F.col("__row")[c].alias(c) for c in rows.columns]
    matched = found.select(*out, *(F.col("__version")[c].alias(prefix + c) for c in added))
    blank = [F.lit(None).cast(versions.schema[c].dataType).alias(prefix + c) for c in added]
    return matched.unionByName(rows.where(~complete).select(*cols(rows.columns), *blank))
