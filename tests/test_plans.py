"""Physical plans: what reaches the scan, and what is shuffled."""

import re

import pytest

from tidemark.operators import incremental as I
from tidemark.operators import reconcile as R
from tidemark.operators.audit import chunk_timings
from tidemark.operators.data_tests import test_relationship as orphans
from tidemark.operators.keys import dedupe
from tidemark.operators.merge import merge
from tidemark.operators.stage import stage
from tidemark.plans.fixtures import load
from tidemark.sources.scan import scan


@pytest.fixture
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_scan_prunes_columns_and_pushes_filters(spark, sf_dir):
    p = plan(scan(spark, f"{sf_dir}/orders.parquet", ["o_orderkey"], "o_custkey > 5"))
    assert "GreaterThan(o_custkey,5)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_watermark_reaches_the_scan(orders, kind):
    hwm = I.watermark_value(orders, "o_orderdate")
    p = plan(I.incremental(orders, "o_orderdate", kind, hwm))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThan(OrEqual)?\(o_orderdate,", p)


def test_small_stage_leaves_the_target_unshuffled(spark, orders):
    staged = stage(spark, orders.where("o_orderkey < 50"))
    for mode in ("upsert", "delete_insert", "insert_ignore"):
        df = merge(orders, staged.rows, "o_orderkey", mode, on_duplicate="unique")
        assert "BroadcastHashJoin" in plan(df), mode
        assert exchanges(df) == 0, mode


def test_large_stage_is_not_broadcast(spark, orders):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        p = plan(merge(orders, orders, "o_orderkey", "upsert", on_duplicate="unique"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_top_rows_per_key_are_limited_before_the_shuffle(orders):
    p = plan(dedupe(orders, "o_custkey", "o_orderdate"))
    partial = p.index("Partial")
    assert "WindowGroupLimit" in p and partial > p.index("Exchange hashpartitioning")
    assert exchanges(dedupe(orders, "o_custkey", "o_orderdate")) == 1


def test_chunk_timings_limit_before_the_shuffle(spark, sf_dir):
    p = plan(chunk_timings(load(spark, sf_dir, "run_log"), "pipeline", ["started_at", "run_id"]))
    assert re.search(r"WindowGroupLimit .*100, Partial", p)


def test_reconcile_keys_shuffles_once(orders):
    df = R.reconcile_keys(orders, orders.where("o_orderkey > 5"), "o_orderkey")
    assert exchanges(df) == 1
    assert "partial_sum" in plan(df) and "Join" not in plan(df)


def test_orphans_are_counted_before_a_shuffle_join(spark, orders):
    """With a small parent Catalyst broadcasts it below the count; else the count is first."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(orphans(orders, "o_custkey", orders, "o_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and p.index("LeftAnti") < p.index("partial_count")


def test_full_sync_does_not_read_the_target(spark, sf_dir, orders):
    target = load(spark, sf_dir, "orders_tgt")
    p = plan(merge(target, orders.withColumnRenamed("o_clerk", "x"), "o_orderkey", "full_sync", "unique"))
    assert p.count("FileScan") == 1


def test_no_python_in_any_plan(spark, sf_dir):
    import __spark_entry__ as contract

    for name in ("clean_by_schema", "merge_upsert", "snapshot_check", "dim_stock_master"):
        p = plan(contract.queries()[name](spark, sf_dir))
        assert "Python" not in p and "CartesianProduct" not in p, name
