"""Incremental filters, data tests, reconciliation, run audit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit as A
from tidemark.operators import data_tests as D
from tidemark.operators import incremental as I
from tidemark.operators import reconcile as R


def keys_of(df):
    return sorted(r["k"] for r in df.collect())


@pytest.fixture
def days(spark):
    return spark.createDataFrame(
        [(i, f"202508{i:02d}", dt.datetime(2025, 8, i), i * 10) for i in range(10, 15)],
        "k int, ymd string, ts timestamp_ntz, v long",
    )


def test_greater_against_greater_or_equal(days):
    assert keys_of(I.incremental(days, "ts", "timestamp", "2025-08-12 00:00:00")) == [13, 14]
    assert keys_of(I.incremental(days, "ymd", "yyyymmdd", "20250812")) == [12, 13, 14]
    assert keys_of(I.incremental(days, "ymd", "yyyymmdd", "20250812", inclusive=False)) == [13, 14]
    assert keys_of(I.incremental(days, "v", "integer", 120)) == [13, 14]
    assert keys_of(I.incremental(days, "v", "default", "120")) == [13, 14]


def test_late_rows_within_the_lag(days):
    got = I.incremental(days, "ts", "timestamp", "2025-08-14 00:00:00", lag="2 days")
    assert keys_of(got) == [13, 14]
    assert keys_of(I.incremental(days, "v", "integer", 140, lag=25)) == [12, 13, 14]


def test_first_run_takes_everything(days):
    for target in (None, days.where("false")):
        hwm = I.watermark_value(target, "ts")
        assert hwm is None
        assert I.incremental(days, "ts", "timestamp", hwm).count() == 5


def test_watermark_survives_the_driver(days):
    hwm = I.watermark_value(days, "ts")
    assert I.incremental(days, "ts", "timestamp", hwm).count() == 0
    assert I.incremental(days, "ts", "timestamp", hwm, inclusive=True).count() == 1


def test_unknown_kind_and_column(days):
    with pytest.raises(ValueError):
        I.incremental(days, "ts", "weekly", "x")
    with pytest.raises(ValueError):
        I.incremental(days, "nope", "timestamp", "x")


def test_predicates(days):
    newer = F.col("v") > 110
    assert keys_of(days.where(I.predicate())) == [10, 11, 12, 13, 14]
    assert keys_of(days.where(I.predicate("k < 13", None, newer))) == [10, 11, 12]
    assert keys_of(days.where(I.predicate("k < 13", None, newer, "and"))) == [12]
    assert keys_of(days.where(I.predicate(None, "k <> 13", newer))) == [12, 14]
    either = I.predicate("k = 10 OR k = 14", "k > 10", None, "and")
    assert keys_of(days.where(either)) == [14]


def test_split_and_like(spark):
    df = spark.createDataFrame(
        [(1, "A-X", "u"), (2, "A", "u"), (3, "A-Y", None), (4, "B-X", "w")],
        "k int, t string, s string",
    )
    assert keys_of(df.where(I.split_part_in("t", "-", 2, ["X"]))) == [1, 4]
    assert keys_of(df.where(I.split_part_in("t", "-", 2, [""]))) == [2]
    assert keys_of(df.where(I.like_not_in("t", "A%", "s", ["w"]))) == [1, 2]


def test_version_mode(spark):
    def mode(rows, limit=2_000_000_000):
        df = spark.createDataFrame([(r,) for r in rows], "v long")
        return tuple(I.version_mode(df, "v", limit).first())

    assert mode([5, 9]) == (9, 4, "incremental_version")
    assert mode([0, 2_000_000_000]) == (2_000_000_000, 2_000_000_000, "full_sync")
    assert mode([0, 2_000_000_000], None)[2] == "incremental_version"
    assert mode([None]) == (0, 0, "incremental_timestamp")


def test_example_suite_fails_on_the_null_id_and_passes_without_it(spark):
    model = spark.createDataFrame([(1,), (None,)], "id int")
    tests = [D.DataTest("m", "id", "unique"), D.DataTest("m", "id", "not_null")]
    status = {r["test"]: r["status"] for r in D.run_tests({"m": model}, tests).collect()}
    assert status == {"unique": "pass", "not_null": "fail"}
    clean = model.where("id IS NOT NULL")
    assert {r["status"] for r in D.run_tests({"m": clean}, tests).collect()} == {"pass"}


def test_relationship_counts_child_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in D.test_relationship(child, "fk", parent, "id").collect()] == [(2, 2)]


def test_bad_tests_are_rejected():
    with pytest.raises(ValueError):
        D.DataTest("t", "c", "odd")
    with pytest.raises(ValueError):
        D.DataTest("t", "c", "relationship")


def pair(spark, source, target):
    return (
        spark.createDataFrame([(x,) for x in source], "k int"),
        spark.createDataFrame([(x,) for x in target], "k int"),
    )


def test_reconcile_keys_is_a_set_difference_with_nulls(spark):
    s, t = pair(spark, [1, 2, 2, None], [2, 3, None])
    assert tuple(R.reconcile_keys(s, t, "k").first()) == (4, 3, 1, 1, False)
    assert sorted(tuple(r) for r in R.key_differences(s, t, "k").collect()) == [
        (1, "missing_in_target"),
        (3, "extra_in_target"),
    ]
    s, t = pair(spark, [None, 1], [1, None, None])
    assert tuple(R.reconcile_keys(s, t, "k").first()) == (2, 3, 0, 0, True)


def test_reconcile_empty_tables(spark):
    s, t = pair(spark, [], [])
    assert tuple(R.reconcile_keys(s, t, "k").first()) == (0, 0, 0, 0, True)
    assert tuple(R.reconcile_counts(s, t).first()) == (0, 0, True)
    assert R.reconcile_rows(s.withColumn("v", F.lit(1)), t.withColumn("v", F.lit(1)), "k").collect() \
        == [("v", 0, 0)]


def test_filter_on_one_or_both_sides(spark):
    s, t = pair(spark, [1, 2, 3], [1, 2, 3])
    one = R.reconcile_keys(s, t, "k", "k > 2", filter_target=False).first()
    both = R.reconcile_keys(s, t, "k", "k > 2").first()
    assert (one["extra_in_target"], both["extra_in_target"]) == (2, 0)


def test_incremental_counts(spark):
    s, t = pair(spark, [1, 2, 3], [9])
    assert tuple(R.reconcile_incremental(s, t, "k > 1").first()) == (2, 1, 1, 0, False)


@pytest.mark.parametrize(
    "source, target, want",
    [
        ([5, 9], [9, 9], (True, 0, 1.0)),
        ([], [], (True, 0, 1.0)),
        ([5, 10], [4], (False, 6, 0.6)),
        ([2_000_000], [1], (False, 1_999_999, 0.5)),
        ([200_000], [1], (False, 199_999, 0.6)),
        ([5], [], (False, 5, 0.7)),
    ],
)
def test_sync_status_and_score(spark, source, target, want):
    s = spark.createDataFrame([(x,) for x in source], "v long")
    t = spark.createDataFrame([(x,) for x in target], "source_version long")
    row = R.integrity_score(R.version_sync_status(s, t, "v")).first()
    assert (row["is_synchronized"], row["sync_gap"], round(row["integrity_score"], 9)) == want


def test_version_distribution_of_nothing(spark):
    df = spark.createDataFrame([], "v long")
    assert tuple(R.version_distribution(df, "v").first()) == (0, None, None, 0, 0, 0)


@pytest.fixture
def log(spark):
    rows = [
        (1, "p", "completed", 60.0, 100, 0, 10.0),
        (2, "p", "failed", 7200.0, 0, 3, 4096.0),
        (3, "p", "running", 0.0, 5, 0, 0.0),
        (4, "q", "completed", 30.0, 300, 0, 3.0),
    ]
    df = spark.createDataFrame(
        rows,
        "run_id int, pipeline string, status string, duration_s double, rows_copied long, "
        "error_count int, memory_mb double",
    )
    started = F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("run_id"))
    return df.withColumn("started_at", started)


def test_progress(log):
    rows = {r["pipeline"]: tuple(r)[1:] for r in A.progress(log, "pipeline").collect()}
    assert rows["q"] == (1, 1, 0, 0, 100.0)
    assert rows["p"][:4] == (3, 1, 1, 1)


def test_health(log):
    rows = {r["pipeline"]: r for r in A.health(log).collect()}
    p, q = rows["p"], rows["q"]
    flags = ("is_slow", "is_failing", "has_many_errors", "is_memory_high", "is_healthy")
    assert [p[f] for f in flags] == [True, True, True, True, False]
    assert [q[f] for f in flags] == [False, False, False, False, True]
    mild = A.Thresholds(1000, 10.0, 5, 10_000)
    assert all(r["is_healthy"] for r in A.health(log, mild).collect())
    assert A.health(log.drop("memory_mb")).count() == 2


def test_throughput_of_nothing_is_zero(log):
    rows = {r["run_id"]: (r["rows_per_second"], r["rows_per_mb"]) for r in A.throughput(log).collect()}
    assert rows[3] == (0.0, 0.0) and rows[4] == (10.0, 100.0)


def test_chunk_timings_look_at_the_last_ones(spark):
    rows = [("r", i, float(i), 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "run string, n int, duration_s double, memory_mb double")
    (row,) = A.chunk_timings(df, "run", ["n"], last=2).collect()
    assert (row["recent_avg_s"], row["avg_s"], row["min_s"], row["max_s"]) == (8.5, 4.5, 0.0, 9.0)


def test_summary(log):
    rows = {r["pipeline"]: r for r in A.summary(log).collect()}
    assert rows["ALL"]["runs"] == 4 and rows["p"]["success_rate_percent"] == 50.0
    assert rows["p"]["last_successful_run"] == dt.datetime(2025, 1, 2)


def test_run_log_is_appended_to(spark, tmp_path):
    path = str(tmp_path / "runs")
    A.append_run(spark, path, [{"run_id": "1", "status": "completed", "metrics": {"x": 1.0}}])
    A.append_run(spark, path, [{"run_id": "2", "status": "failed", "rows_copied": 5}])
    assert A.progress(A.read_runs(spark, path)).count() == 2
    with pytest.raises(ValueError):
        A.append_run(spark, path, [{"colour": "red"}])
