"""Scans. Filters and column lists are declared, so they reach the Parquet or JDBC reader."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, check_identifier, col, cols, require_columns
from tidemark.sources.jdbc import JdbcTable


def resolve(spark: SparkSession, source: Any) -> DataFrame:
    """A DataFrame from a DataFrame, a JDBC table, a path, or a catalog table name."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, JdbcTable):
        return source.read(spark)
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(check_identifier(source))


def scan(
    spark: SparkSession,
    source: Any,
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Read ``source``: some or all columns, an optional predicate, sorted only on request."""
    df = resolve(spark, source)
    if where is not None:
        df = df.where(where)
    if columns is not None:
        require_columns(df.columns, columns, "scan")
        df = df.select(*cols(columns))
    if order_by is not None:
        df = df.orderBy(*cols(as_list(order_by)))
    return df


def scan_count(
    spark: SparkSession, source: Any, where: str | Column | None = None
) -> DataFrame:
    """One row: the number of rows under ``where``."""
    return scan(spark, source, where=where).agg(F.count(F.lit(1)).alias("row_count"))


def scan_sql(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame],
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A user's own SELECT in place of the generated one.

    Tables are named ``{name}`` in the text and values ``:name``; values are bound, not
    pasted, so they cannot change the statement.
    """
    return spark.sql(text, args=dict(args or {}), **tables)


def key_range(df: DataFrame, key: str) -> tuple[int, int] | None:
    """Lowest and highest key, or None for an empty table (one aggregate, two numbers)."""
    lo, hi = df.agg(F.min(col(key)), F.max(col(key))).first()
    return None if lo is None else (int(lo), int(hi))


def chunk_by_key(
    df: DataFrame, key: str, n: int, bounds: tuple[int, int] | None = None
) -> DataFrame:
    """Add ``chunk``: which of ``n`` equal key ranges a row falls in.

    One projection instead of ``n`` ordered LIMIT/OFFSET reads. Without ``bounds`` the
    key range is looked up first. A NULL key has a NULL chunk.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    bounds = bounds or key_range(df, key)
    if bounds is None:
        return df.withColumn("chunk", F.lit(None).cast("long"))
    lo, hi = bounds
    span = hi - lo + 1
    # Stay in 64-bit arithmetic while the largest product fits, else go decimal.
    wide = "long" if span * n < 2**63 else "decimal(25,0)"

    def whole(number: int) -> Column:
        # As text: a Python integer may be wider than 64 bits.
        return F.lit(str(number)).cast(wide)

    product = (col(key).cast(wide) - whole(lo)) * whole(n)
    # Integer division; offsets are never negative, so it equals floor().
    chunk = F.call_function("div", product, whole(span))
    return df.withColumn("chunk", chunk.cast("long"))


def balanced_chunks(df: DataFrame, key: str, n: int) -> DataFrame:
    """The rows in ``n`` partitions of ascending key ranges with about equal row counts.

    Rows of one key may lie in several partitions: a hash of the row splits a frequent key.

    For keys that are unevenly spread, where equal key ranges would differ in size. Spark
    samples the keys to find the ranges. Writing the result gives one file per chunk.
    """
    spread = F.xxhash64(*cols(df.columns))
    return df.repartitionByRange(n, col(key), spread).sortWithinPartitions(col(key))


def chunk_stats(chunked: DataFrame, key: str) -> DataFrame:
    """Rows and key range per chunk (partial aggregates, one row per chunk shuffled)."""
    return chunked.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(col(key)).alias("first_key"),
        F.max(col(key)).alias("last_key"),
    )
