"""Digests of key ranges against full comparison, and what the last read skips."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests as G
from tidemark.operators import reconcile as R
from tidemark.plans.fixtures import load

SCHEMA = "k long, a string, b double"


def both(spark, source, target, schema=SCHEMA):
    return spark.createDataFrame(source, schema), spark.createDataFrame(target, schema)


@pytest.fixture
def tables(spark, sf_dir):
    return load(spark, sf_dir, "orders"), load(spark, sf_dir, "orders_drift")


def test_narrowing_covers_all_that_differs(tables, rows):
    source, target = tables
    found = G.narrow(source, target, "o_orderkey", fan_out=32, enough=50)
    assert len(found.levels) > 1 and found.levels[-1].differing_rows < 400
    assert all(x.differing_rows <= x.rows for x in found.levels)
    outside = ~found.where
    assert rows(source.where(outside)) == rows(target.where(outside))
    assert found.equal_rows == source.where(outside).count()


@pytest.mark.parametrize("fan_out", [3, 64])
def test_same_report_as_the_full_comparison(tables, rows, fan_out):
    source, target = tables
    want = rows(R.reconcile_rows(source, target, "o_orderkey"))
    assert rows(G.reconcile_rows_digest(source, target, "o_orderkey", fan_out=fan_out, enough=20)) == want
    want = rows(R.reconcile_keys(source, target, "o_orderkey"))
    assert rows(G.reconcile_keys_digest(source, target, "o_orderkey", fan_out, 20)) == want


def test_equal_tables_are_not_read_again(tables):
    source, _ = tables
    found = G.narrow(source, source, "o_orderkey")
    assert found.levels[-1].differing == 0 and found.equal_rows == source.count()
    report = G.reconcile_rows_digest(source, source, "o_orderkey").collect()
    assert all(r["mismatches"] == 0 and r["compared"] == found.equal_rows for r in report)


def test_last_read_skips_row_groups(spark, tables, tmp_path):
    """On tables clustered by the key only the row groups of differing ranges are read."""
    source, target = tables
    paths = [str(tmp_path / n) for n in ("s", "t")]
    for df, path in zip((source, target), paths, strict=True):
        (df.repartition(1).sortWithinPartitions("o_orderkey").write
         .option("parquet.block.size", 8_192).option("parquet.page.size", 1_024).parquet(path))
    source, target = (spark.read.parquet(p) for p in paths)
    found = G.narrow(source, target, "o_orderkey", fan_out=32, enough=50)
    read = source.where(found.where)
    plan = read._jdf.queryExecution().executedPlan()
    assert re.search(r"PushedFilters: \[[^]]*o_orderkey", plan.toString())
    read.collect()
    leaves = plan.collectLeaves()
    scanned = leaves.apply(0).metrics().apply("numOutputRows").value()
    assert 0 < scanned < source.count() / 2


def test_nulls_repeats_and_order(spark, rows):
    source = [(1, "a", 1.0), (2, None, 2.0), (3, "", None), (None, "n", 1.0), (None, "m", 1.0), (9, "z", -0.0)]
    target = [(9, "z", 0.0), (3, None, None), (2, "", 2.0), (1, "a", 1.0), (None, "n", 1.0), (7, "new", 7.0)]
    s, t = both(spark, source, target)
    assert rows(G.reconcile_rows_digest(s, t, "k", enough=0)) == rows(R.reconcile_rows(s, t, "k"))
    assert rows(G.reconcile_keys_digest(s, t, "k", enough=0)) == rows(R.reconcile_keys(s, t, "k"))
    twice = s.unionByName(s)
    assert rows(G.reconcile_keys_digest(twice, t, "k", enough=0)) == rows(R.reconcile_keys(twice, t, "k"))


def test_a_null_that_moves_to_another_column_is_a_difference(spark):
    s, t = both(spark, [(1, "x", None)], [(1, None, None)])
    assert G.narrow(s, t, "k").levels[0].differing == 1
    schema = "k long, a string, b string"
    s, t = both(spark, [(1, "x", None)], [(1, None, "x")], schema)
    assert G.narrow(s, t, "k").levels[0].differing == 1


def test_repeated_rows_do_not_cancel(spark):
    s, t = both(spark, [(1, "x", 1.0)] * 2, [(1, "y", 1.0)] * 2)
    assert G.narrow(s, t, "k").levels[0].differing == 1
    s, t = both(spark, [(1, "x", 1.0)] * 3, [(1, "x", 1.0)])
    assert G.narrow(s, t, "k").levels[0].differing == 1


def test_empty_sides(spark, rows):
    s, t = both(spark, [(1, "x", 1.0)], [])
    for a, b in ((s, t), (t, s), (t, t)):
        assert rows(G.reconcile_rows_digest(a, b, "k")) == rows(R.reconcile_rows(a, b, "k"))
        assert rows(G.reconcile_keys_digest(a, b, "k")) == rows(R.reconcile_keys(a, b, "k"))


@pytest.mark.parametrize(
    "kind,make",
    [
        ("string", lambda i: f"k{i:04d}é'"),
        ("date", lambda i: dt.date(2000, 1, 1) + dt.timedelta(i)),
        ("timestamp_ntz", lambda i: dt.datetime(2000, 1, 1) + dt.timedelta(minutes=i, microseconds=i)),
        ("decimal(12,3)", lambda i: Decimal(i) / 8),
        ("double", lambda i: i / 3 if i < 299 else float("nan")),
    ],
)
def test_key_types(spark, rows, kind, make):
    source = [(make(i), i) for i in range(300)]
    target = [(make(i), i + (i in (50, 51))) for i in range(300) if i != 120]
    s, t = both(spark, source, target, f"k {kind}, v int")
    found = G.narrow(s, t, "k", fan_out=16, enough=10)
    assert found.levels[-1].differing_rows < 150
    assert rows(G.reconcile_rows_digest(s, t, "k", fan_out=16, enough=10)) == rows(R.reconcile_rows(s, t, "k"))


def test_keys_of_several_columns(spark, rows):
    source = [(i // 50, f"p{i % 50:02d}", i) for i in range(400)]
    target = [(a, b, v + (v == 77)) for a, b, v in source if v != 311]
    schema = "`a.b` int, p string, v int"
    s, t = both(spark, source, target, schema)
    keys = ["a.b", "p"]
    found = G.narrow(s, t, keys, fan_out=16, enough=10)
    assert found.levels[-1].differing_rows < 150
    got = G.reconcile_rows_digest(s, t, keys, fan_out=16, enough=10)
    assert rows(got) == rows(R.reconcile_rows(s, t, keys))


def test_hot_key_is_one_bound(spark, rows):
    """Half of all rows have one key (set comparison allows repeats)."""
    s = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"))
    t = s.where("k <> 1999")
    assert rows(G.reconcile_keys_digest(s, t, "k", 16, 10)) == rows(R.reconcile_keys(s, t, "k"))
