"""Chunked copies: equal sizes, restarts, changed sources."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans.chunked_copy import NO_KEY, ChunkedCopy, equal_bounds


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def source(spark):
    """Keys crowded at one end, one frequent key, NULL keys."""
    return spark.range(3_000).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )


def test_a_copy_in_one_run(spark, source, tmp_path):
    copy = ChunkedCopy(spark, str(tmp_path / "c"), "k", chunks=8, per_wave=3)
    n = copy.run(source)
    assert n == len(copy.bounds(source)) + 2 and copy.missing(source) == []
    assert rows_of(copy.read(source.schema)) == rows_of(source)
    sizes = {r["chunk"]: r["row_count"] for r in copy.done().collect()}
    assert sizes[NO_KEY] == 60 and sum(sizes.values()) == 3_000
    assert copy.run(source) == 0 and copy.stale(source) == []


def test_a_stopped_run_goes_on(spark, source, tmp_path):
    """The second run gets a source that fails on everything the first one copied."""
    copy = ChunkedCopy(spark, str(tmp_path / "c"), "k", chunks=8, per_wave=2)
    assert copy.run(source, max_waves=2) == 4
    finished = {r["chunk"] for r in copy.done().collect()}
    assert finished == {NO_KEY, 0, 1, 2}
    last = int(copy.bounds(source)[2][0])
    guarded = source.withColumn(
        "v", F.when(F.col("k") < last, F.raise_error(F.lit("read again"))).otherwise(F.col("v"))
    )
    copy.run(guarded)
    assert rows_of(copy.read(source.schema)) == rows_of(source)


def test_a_failed_wave_is_done_again(spark, source, tmp_path):
    copy = ChunkedCopy(spark, str(tmp_path / "c"), "k", chunks=8, per_wave=2)
    bounds = copy.bounds(source)
    bad = source.withColumn("v", F.when(F.col("k") >= int(bounds[4][0]), F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        copy.run(bad)
    left = copy.missing(source)
    assert left and left[-1] == len(bounds)
    assert copy.run(source) == len(left)
    assert rows_of(copy.read(source.schema)) == rows_of(source)


def test_only_changed_chunks_are_copied_again(spark, source, tmp_path):
    copy = ChunkedCopy(spark, str(tmp_path / "c"), "k", chunks=10)
    copy.run(source)
    low = int(copy.bounds(source)[3][0])
    changed = source.withColumn("v", F.when(F.col("k") == low, "new").otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(10**12, "beyond the plan"), (None, "no key")], "k long, v string")
    )
    last = len(copy.bounds(source))
    assert copy.stale(changed) == [NO_KEY, 4, last]
    assert copy.refresh(changed) == 3
    assert rows_of(copy.read(source.schema)) == rows_of(changed)
    emptied = changed.where(f"k IS NULL OR k < {low}")
    copy.refresh(emptied)
    assert rows_of(copy.read(source.schema)) == rows_of(emptied)


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp_ntz", "decimal(20,2)", "string"])
def test_bounds_split_evenly(spark, kind):
    r = random.Random(1)
    values = sorted({int(r.lognormvariate(8, 1.5)) for _ in range(3_000)})
    cast = {
        "date": "date_add(DATE'1990-01-01', CAST(n % 100000 AS INT))",
        "timestamp_ntz": "CAST(timestamp_seconds(n * 1000) AS TIMESTAMP_NTZ)",
        "string": "lpad(CAST(n AS STRING), 9, '0')",
    }.get(kind, f"CAST(n AS {kind})")
    df = spark.createDataFrame([(v,) for v in values], "n long").selectExpr(f"{cast} AS k")
    bounds = equal_bounds(df, ["k"], 10)
    assert len(bounds) == 9 and bounds == sorted(bounds, key=lambda b: float(b[0]) if kind in ("bigint", "double", "decimal(20,2)") else b[0])
    copy_sizes = df.groupBy(
        sum((F.col("k") >= F.lit(b[0]).cast(kind)).cast("int") for b in bounds).alias("c")
    ).count().collect()
    most = max(r["count"] for r in copy_sizes)
    assert len(copy_sizes) == 10 and most < df.count() / 10 * (2.2 if kind == "string" else 1.3)


def test_keys_of_several_columns_and_pushed_filters(spark, tmp_path):
    df = spark.range(500).selectExpr("id % 7 AS a", "concat('p', id % 13) AS b", "id AS v")
    df.write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    copy = ChunkedCopy(spark, str(tmp_path / "c"), ["a", "b"], chunks=5, per_wave=2)
    copy.run(source)
    assert rows_of(copy.read(source.schema)) == rows_of(source)
    plan = copy._numbered(source, [1], copy.bounds(source))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a," in plan


def test_empty_source(spark, source, tmp_path):
    copy = ChunkedCopy(spark, str(tmp_path / "c"), "k")
    assert copy.run(source.limit(0)) == 2 and rows_of(copy.read(source.schema)) == []
    with pytest.raises(ValueError, match="at least 1"):
        ChunkedCopy(spark, str(tmp_path), "k", chunks=0)
