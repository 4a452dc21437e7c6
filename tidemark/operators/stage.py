"""Staging: a delta as a table of its own, with its counts."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.types import ColumnSpec
from tidemark.operators.shape import conform
from tidemark.session import work_dir
from tidemark.sources.versions import counted_write


@dataclass(frozen=True)
class StagedTable:
    """``rows`` read back from the stage folder, and how many were written."""

    rows: DataFrame
    path: str
    row_count: int


def stage(
    spark: SparkSession,
    df: DataFrame,
    shape: Sequence[ColumnSpec] | None = None,
    run_ts: object = None,
    path: str | None = None,
) -> StagedTable:
    """Write ``df`` (conformed to ``shape``) once and read it back.

    The merge and its statistics then read the same rows, however often they are
    recomputed, and Spark knows the stage's real size when it picks join strategies.
    Rows are counted while they are written. The stage lies in the shared folder, so it
    outlives a lost executor.
    """
    if shape is not None:
        df = conform(df, shape, run_ts)
    path = path or work_dir(spark, "stage")
    row_count = counted_write(df, path)
    return StagedTable(spark.read.schema(df.schema).parquet(path), path, row_count)


def drop_stage(spark: SparkSession, staged: StagedTable) -> None:
    """Remove the stage folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(staged.path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop_path, True)


@contextmanager
def staged(spark: SparkSession, df: DataFrame, shape=None, run_ts=None):
    """A stage that is dropped on the way out, also after a failure."""
    table = stage(spark, df, shape, run_ts)
    try:
        yield table
    finally:
        drop_stage(spark, table)
