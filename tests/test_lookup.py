"""Rows by staged keys: what is found, and how many row groups are read for it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.lookup import key_filter, rows_of_keys, write_clustered


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def scanned_rows(df):
    """Rows that left the scan: whole row groups, as far as they weren't skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "clustered")
    df = spark.range(60_000).selectExpr("id * 3 AS k", "concat('value ', id % 977) AS v", "uuid() AS pad")
    write_clustered(df, path, "k", 4, 64 << 10, 2_000)
    return spark.read.parquet(path)


def test_hundred_keys_read_few_row_groups(spark, clustered):
    """Bloom filters and extremes: at most one row group a key, of some tens of thousands of rows fewer than one in ten."""
    near = spark.createDataFrame([(k * 3,) for k in range(1_000, 1_100)], "k long")
    found = rows_of_keys(clustered, near, "k")
    assert found.count() == 100
    assert scanned_rows(clustered.where(key_filter(near, "k"))) < 6_000
    # Keys between those of the table lie within the extremes, but no Bloom filter knows them.
    absent = spark.createDataFrame([(k * 3 + 1,) for k in range(0, 60_000, 600)], "k long")
    assert rows_of(rows_of_keys(clustered, absent, "k")) == []
    assert scanned_rows(clustered.where(key_filter(absent, "k"))) < 30_000


def test_many_keys_become_ranges(spark, clustered):
    some = spark.range(30_000, 32_000).selectExpr("id * 3 AS k")
    assert rows_of_keys(clustered, some, "k").count() == 2_000
    assert scanned_rows(clustered.where(key_filter(some, "k"))) < 12_000


@pytest.mark.parametrize("few", [3, 500])
@pytest.mark.parametrize("kind", ["long", "string", "date", "decimal(10,2)"])
def test_same_rows_as_a_semi_join(spark, few, kind):
    r = random.Random(few)
    make = {
        "long": lambda i: i, "string": lambda i: f"k'{i}\\", "date": lambda i: dt.date(2000, 1, 1) + dt.timedelta(i),
    }.get(kind)
    from decimal import Decimal

    make = make or (lambda i: Decimal(i) / 4)
    target = spark.createDataFrame(
        [(make(i // 2), i) for i in range(400)] + [(None, -1)], f"`a.k` {kind}, v int"
    )
    stage = spark.createDataFrame([(make(r.randrange(300)), 1) for _ in range(40)] + [(None, 1)], f"`a.k` {kind}, x int")
    want = target.join(stage.select(F.col("`a.k`").alias("k2")).distinct(), F.col("`a.k`") == F.col("k2"), "left_semi")
    assert rows_of(rows_of_keys(target, stage, "a.k", few, 4)) == rows_of(want)


def test_several_key_columns_other_types_and_nothing(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3)], "k long, p string, v int")
    stage = spark.createDataFrame([(1, "b"), (2, "x")], "k long, p string")
    assert rows_of(rows_of_keys(target, stage, ["k", "p"])) == [(1, "b", 2)]
    assert rows_of(rows_of_keys(target, stage.withColumn("k", F.col("k").cast("int")), "k")) == rows_of(target)
    assert rows_of(rows_of_keys(target, stage.limit(0), "k")) == []
