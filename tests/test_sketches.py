"""Merged sketches against exact values of all rows, and what a load reads."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches as K
from tidemark.operators.shape import profile
from tidemark.plans.fixtures import load
from tidemark.session import work_dir

AWKWARD = [
    (1, float("nan"), None, True, dt.date(2020, 1, 1), Decimal("1.50"), [1], None, dt.datetime(2020, 1, 1)),
    (2, -0.0, "", None, None, None, None, None, None),
    (2, 0.0, "x", None, None, None, None, None, None),
]
SCHEMA = "`a.b` int, f double, s string, b boolean, d date, m decimal(10,2), l array<int>, n string, t timestamp_ntz"


def as_dict(report):
    return {r["column_name"]: r for r in report.collect()}


@pytest.fixture
def orders(spark, sf_dir):
    return load(spark, sf_dir, "orders")


def test_merged_profile_has_the_exact_parts_and_bounded_errors(spark, orders):
    store = K.ProfileStore(spark, work_dir(spark, "profiles"), orders.schema)
    for k in range(4):
        store.add(f"0{k}", orders.where(f"o_orderkey % 4 = {k}"))
    got, want = as_dict(store.report()), as_dict(profile(orders, exact=True))
    assert set(got) == set(want)
    for name, r in got.items():
        for part in ("row_count", "null_count", "min_value", "max_value"):
            assert r[part] == want[name][part]
        # Below 4,096 values the count is exact.
        assert r["distinct_count"] == want[name]["distinct_count"]
    n = orders.count()
    for q, v in zip(K.QUANTILES, got["o_totalprice"]["quantiles"], strict=True):
        assert abs(orders.where(F.col("o_totalprice") <= float(v)).count() / n - q) < 0.03
    want = {r[0]: r[1] for r in orders.groupBy("o_orderpriority").count().collect()}
    assert {r["value"]: r["count"] for r in got["o_orderpriority"]["frequent"]} == want


def test_many_distinct_values_and_a_hot_one(spark):
    """60,000 values, and one of them in a third of all rows."""
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    halves = [K.sketched(df.where(f"v % 2 = {k}")) for k in (0, 1)]
    both = K.merged(halves[0].unionByName(halves[1]), df.schema)
    (r,) = K.report(both, df.schema).collect()
    exact = df.distinct().count()
    assert abs(r["distinct_count"] - exact) <= 0.04 * exact
    top = r["frequent"][0]
    assert top["value"] == "7" and abs(top["count"] - 30_000) <= 3.5 / K.TRACKED * 90_000


def test_adding_a_load_again_replaces_it(spark, orders):
    store = K.ProfileStore(spark, work_dir(spark, "profiles"), orders.schema)
    store.add("001", orders.where("o_orderkey < 10"))
    store.add("2024-01-01", orders.where("o_orderkey >= 10"))
    store.add("2024-01-01", orders.where("o_orderkey >= 10"))
    assert as_dict(store.report())["o_orderkey"]["row_count"] == orders.count()
    assert as_dict(store.report(["001"]))["o_orderkey"]["row_count"] == orders.where("o_orderkey < 10").count()


def test_profile_after_a_load_reads_no_rows_of_the_table(spark, orders, tmp_path):
    store = K.ProfileStore(spark, str(tmp_path / "profiles"), orders.schema)
    store.add("a", orders)
    files = store.report().inputFiles()
    assert len(files) == 1 and "/profiles/load=a/" in files[0]


def test_awkward_columns(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    got = as_dict(K.report(K.sketched(df), df.schema))
    assert "l" not in got
    assert got["s"]["distinct_count"] == 2 and got["s"]["null_count"] == 1
    assert got["n"]["null_count"] == 3 and got["n"]["quantiles"] is None and got["n"]["frequent"] == []
    assert got["f"]["max_value"] == "NaN"
    assert got["m"]["quantiles"] == ["1.50"] * 3 and got["d"]["quantiles"] == ["2020-01-01"] * 3
    assert got["t"]["quantiles"] == ["2020-01-01 00:00:00"] * 3
    assert got["a.b"]["min_value"] == "1"
    exact = as_dict(profile(df, exact=True))
    assert exact["l"]["distinct_count"] == 1 and exact["n"]["distinct_count"] == 0
    assert exact["f"]["distinct_count"] == 2 and exact["s"]["distinct_count"] == 2


def test_empty_load(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    empty = K.sketched(df.limit(0))
    both = K.merged(empty.unionByName(K.sketched(df)), df.schema)
    assert as_dict(K.report(both, df.schema)) == as_dict(K.report(K.sketched(df), df.schema))
    assert all(r["row_count"] == 0 and r["min_value"] is None for r in K.report(empty, df.schema).collect())


def test_drift_of_values(spark):
    old = spark.range(1_000).select(F.col("id").alias("v"), F.lit("a").alias("s"))
    new = spark.range(1_000).select((F.col("id") + 500).alias("v"), F.when(F.col("id") % 2 == 0, "b").alias("s"))
    got = as_dict(K.value_drift(K.sketched(old), K.sketched(new), old.schema))
    assert got["v"]["new_values"] == 500 and abs(got["v"]["shift"] - 0.5) < 0.05
    assert got["s"]["new_values"] == 1 and got["s"]["null_rate_change"] == 0.5 and got["s"]["shift"] is None
    same = as_dict(K.value_drift(K.sketched(old), K.sketched(old), old.schema))
    assert same["v"]["new_values"] == 0 and same["v"]["shift"] < 0.05
