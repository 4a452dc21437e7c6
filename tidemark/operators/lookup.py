"""Rows of a large table by staged keys, read from the row groups that can hold them.

The staged side is small and known, so it becomes a filter of literals in front of the join: a list of keys where they are
few, else ranges around them. Parquet statistics, dictionaries and Bloom filters then skip row groups
before a page is read; on tables written by :func:`write_clustered` that leaves few of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, col, cols, quote, require_columns
from tidemark.operators.keys import any_null
from tidemark.operators.ranges import literal, range_of, sampled_bounds, types_of

# Spark hands an IN list of at most this many values to Parquet as a list; a longer one as its extremes.
IN_LIST = 10
FEW = 500
RANGES = 64


def write_clustered(
    df: DataFrame, path: str, key: str | Sequence[str], files: int, group_bytes: int = 32 << 20, distinct: int | None = None
) -> None:
    """Write ``df`` as Parquet, clustered by its key, with a Bloom filter per row group on each key column.

    Files hold ranges of the key and are sorted inside, so row groups have narrow extremes; the filter serves
    keys that come in no order. ``distinct`` is how many values a row group is expected to hold, for the size of its filter
    (by default Parquet's own). Rows of a frequent key are spread over files by a hash of the row.
    """
    keys = as_list(key)
    require_columns(df.columns, keys, "write_clustered")
    spread = F.xxhash64(*cols(df.columns))
    writer = (
        df.repartitionByRange(files, *cols(keys), spread).sortWithinPartitions(*cols(keys))
        .write.option("parquet.block.size", group_bytes)
    )
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        if distinct:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{k}", distinct)
    writer.parquet(path)


def key_filter(stage: DataFrame, key: str | Sequence[str], few: int = FEW, ranges: int = RANGES) -> Column:
    """A filter of literals that is true for every row whose key is staged (and for others, at times).

    Of several key columns the first one. At most ``few`` values are listed; more become ``ranges`` stretches,
    each from the least to the greatest staged value in it. NULLs are staged for nobody (SQL rule). Without a staged key nothing passes.
    """
    first = as_list(key)[0]
    require_columns(stage.columns, [first], "key_filter")
    (dtype,) = types_of(stage, [first])
    values = stage.where(col(first).isNotNull()).select(col(first)).distinct()
    listed = [r[0] for r in values.limit(few + 1).select(col(first).cast("string")).collect()]
    if not listed:
        return F.lit(False)
    name = quote(first)
    if len(listed) <= few:
        # In order, so that lists that lie together rule out row groups together.
        texts = [f"{name} IN ({', '.join(literal(v, dtype) for v in listed[i : i + IN_LIST])})" for i in range(0, len(listed), IN_LIST)]
        return F.expr(" OR ".join(texts))
    keyed = stage.where(~any_null([first]))
    bounds = [
        (r[0],) for r in sampled_bounds(keyed.select(col(first)), [first], ranges).orderBy(col(first)).select(col(first).cast("string")).collect()
    ]
    stretches = (
        keyed.groupBy(range_of([first], [dtype], bounds).alias("r"))
        .agg(F.min(col(first)).alias("low"), F.max(col(first)).alias("high"))
        .select(F.col("low").cast("string"), F.col("high").cast("string")).collect()
    )
    tests = [f"({name} >= {literal(s[0], dtype)} AND {name} <= {literal(s[1], dtype)})" for s in stretches]
    return F.expr(" OR ".join(tests))


def rows_of_keys(target: DataFrame, stage: DataFrame, key: str | Sequence[str], few: int = FEW, ranges: int = RANGES) -> DataFrame:
    """The rows of ``target`` whose key is in ``stage``, each once (SQL rule for NULL keys).

    ``stage`` is read for its keys first, so it should be a staged table. Keys of both sides are of one type.
    """
    keys = as_list(key)
    require_columns(target.columns, keys, "target")
    require_columns(stage.columns, keys, "stage")
    if types_of(target, keys[:1]) != types_of(stage, keys[:1]):
        # A filter by another type would be put around the column, where no statistics reach.
        return target.join(stage.select(*cols(keys)).distinct(), keys, "left_semi").select(*cols(target.columns))
    near = target.where(key_filter(stage, keys, few, ranges))
    return near.join(stage.select(*cols(keys)).distinct(), keys, "left_semi").select(*cols(target.columns))
