"""History snapshots and change logs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import change_log as L
from tidemark.operators import history as H

T1, T2, T3 = (dt.datetime(2025, 1, d) for d in (1, 2, 3))
SCHEMA = "k string, v int, w string"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def versions(df):
    """(key, value, from, to) in order, times as day numbers."""
    day = lambda t: t.day if t else None
    rows = df.collect()
    return sorted(
        ((r["k"], r["v"], day(r["scd_valid_from"]), day(r["scd_valid_to"])) for r in rows), key=repr
    )


def run(history, source, ts, **kw):
    return H.snapshot(history, source, "k", "check", ts, **kw)


def test_change_close_and_return_of_a_key(spark):
    h = run(None, table(spark, [("a", 1, "x"), ("b", 1, "x")]), T1)
    h = run(h, table(spark, [("a", 2, "x")]), T2, hard_deletes=True)
    assert versions(h) == [("a", 1, 1, 2), ("a", 2, 2, None), ("b", 1, 1, 2)]
    h = run(h, table(spark, [("a", 2, "x"), ("b", 1, "x")]), T3, hard_deletes=True)
    assert versions(h) == [("a", 1, 1, 2), ("a", 2, 2, None), ("b", 1, 1, 2), ("b", 1, 3, None)]
    gaps = H.history_gaps(h, "k")
    assert [(r["k"], r["v"]) for r in gaps.collect()] == [("b", 1)]


def test_without_hard_deletes_versions_stay_open(spark):
    h = run(None, table(spark, [("a", 1, "x"), ("b", 1, "x")]), T1)
    h = run(h, table(spark, [("a", 1, "x")]), T2)
    assert versions(h) == [("a", 1, 1, None), ("b", 1, 1, None)]


def test_only_checked_columns_count_and_nulls_compare(spark):
    h = run(None, table(spark, [("a", None, "x"), ("b", 1, "x")]), T1)
    h = run(h, table(spark, [("a", None, "y"), ("b", None, "x")]), T2, check_cols=["v"])
    assert versions(h) == sorted([("a", None, 1, None), ("b", 1, 1, 2), ("b", None, 2, None)], key=repr)


def test_null_keys_never_match(spark):
    h = run(None, table(spark, [(None, 1, "x")]), T1)
    again = run(h, table(spark, [(None, 1, "x")]), T2)
    assert versions(again) == sorted([(None, 1, 1, None), (None, 1, 2, None)], key=repr)
    closed = run(h, table(spark, [(None, 1, "x")]), T2, hard_deletes=True)
    assert versions(closed) == sorted([(None, 1, 1, 2), (None, 1, 2, None)], key=repr)


def test_same_run_ts_as_an_open_version(spark):
    """A second run at the same time changes an open version into an empty interval."""
    h = run(None, table(spark, [("a", 1, "x")]), T1)
    h = run(h, table(spark, [("a", 2, "x")]), T1)
    assert versions(h) == [("a", 1, 1, 1), ("a", 2, 1, None)]
    assert H.as_of(h, T1).collect()[0]["v"] == 2


def test_timestamp_strategy(spark):
    schema = "k string, v int, at timestamp_ntz"
    h = H.snapshot(None, table(spark, [("a", 1, T1), ("b", 1, T1)], schema), "k", "timestamp",
                   updated_at="at")
    newer = table(spark, [("a", 2, T2), ("b", 9, T1), ("c", 1, T2)], schema)
    h = H.snapshot(h, newer, "k", "timestamp", updated_at="at")
    assert versions(h) == [("a", 1, 1, 2), ("a", 2, 2, None), ("b", 1, 1, None), ("c", 1, 2, None)]


def test_prefix_and_wrong_arguments(spark):
    names = H.HistoryColumns("hist_")
    h = H.snapshot(None, table(spark, [("a", 1, "x")]), "k", "check", T1, names=names)
    assert h.columns[-3:] == ["hist_valid_from", "hist_valid_to", "hist_updated_at"]
    source = table(spark, [])
    for kw in ({"strategy": "x"}, {"strategy": "check"}, {"strategy": "timestamp"}):
        with pytest.raises(ValueError):
            H.snapshot(None, source, "k", **kw)


def test_history_in_order(spark):
    h = run(None, table(spark, [("b", 1, "x"), ("a", 1, "x")]), T1)
    h = run(h, table(spark, [("b", 2, "x"), ("a", 2, "x")]), T2)
    rows = [(r["k"], r["v"]) for r in H.history_of(h, "k").collect()]
    assert rows == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert H.history_of(h, "k", F.col("k") == "a").count() == 2


def test_composite_key(spark):
    df = table(spark, [("a", 1, "x"), (None, 2, "y"), ("", 3, "z")])
    keys = [r[0] for r in df.select(H.composite_key(["k", "v", "w"])).collect()]
    assert keys == ["a|1|x", None, "|3|z"]


STATES = st.lists(
    st.dictionaries(st.sampled_from("abcd"), st.integers(0, 2), max_size=4), min_size=1, max_size=3
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(states=STATES)
def test_as_of_gives_back_each_state(spark, states):
    history = None
    for i, state in enumerate(states):
        rows = [(k, v, "") for k, v in state.items()]
        ts = dt.datetime(2025, 1, 1 + i)
        history = H.snapshot(history, table(spark, rows), "k", "check", ts, hard_deletes=True)
    for i, state in enumerate(states):
        at = H.as_of(history, dt.datetime(2025, 1, 1 + i, 12))
        assert {r["k"]: r["v"] for r in at.collect()} == state


ROWS = st.dictionaries(
    st.one_of(st.none(), st.integers(0, 5)),
    st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["", "é", '"q"', "한"])),
    max_size=5,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=ROWS, new=ROWS)
def test_replaying_the_difference_gives_the_new_state(spark, old, new):
    schema = "k int, v int, w string"
    a = table(spark, [(k, *v) for k, v in old.items()], schema)
    b = table(spark, [(k, *v) for k, v in new.items()], schema)
    changes = L.diff(a, b, "k")
    log = L.from_log(L.to_log(changes, "t", "k", T1), b.schema)
    got = sorted((tuple(r) for r in L.apply_log(a, log, "k").collect()), key=repr)
    assert got == sorted(((k, *v) for k, v in new.items()), key=repr)


def test_diff_operations(spark):
    a = table(spark, [("a", 1, "x"), ("b", 1, "x"), ("c", 1, None)])
    b = table(spark, [("a", 1, "x"), ("b", 2, "x"), ("d", 1, "x"), ("c", 1, None)])
    got = sorted(
        (r["operation"], (r["after"] or r["before"])["k"]) for r in L.diff(a, b, "k").collect()
    )
    assert got == [("INSERT", "d"), ("UPDATE", "b")]
    got = sorted((r["operation"], r["before"]["k"]) for r in L.diff(b, a, "k").collect())
    assert got == [("DELETE", "d"), ("UPDATE", "b")]


def test_last_operation_of_a_key_wins(spark):
    base = table(spark, [("a", 1, "x"), ("b", 1, "x")])
    row = "struct<k:string,v:int,w:string>"
    log = spark.createDataFrame(
        [
            (1, "UPDATE", ("a", 1, "x"), ("a", 2, "x")),
            (3, "DELETE", ("a", 3, "x"), None),
            (2, "UPDATE", ("a", 2, "x"), ("a", 3, "x")),
            (1, "DELETE", ("b", 1, "x"), None),
            (2, "INSERT", None, ("b", 5, "y")),
        ],
        f"seq int, operation string, before {row}, after {row}",
    )
    got = [tuple(r) for r in L.apply_log(base, log, "k", "seq").collect()]
    assert got == [("b", 5, "y")]


def test_log_rows(spark):
    df = table(spark, [("a", None, "한")])
    (row,) = L.append_log(df, "t", ["k", "w"], T1).collect()
    assert row.asDict() == {
        "table_name": "t",
        "operation": "INSERT",
        "record_id": "a|한",
        "old_data": None,
        "new_data": '{"k":"a","v":null,"w":"한"}',
        "changed_at": T1,
    }


def test_stored_history(spark, rows, tmp_path):
    from tidemark.plans.snapshots import SnapshotTable

    def table(**kw):
        return SnapshotTable(spark, str(tmp_path / "h"), "k", hard_deletes=True, **kw)

    def load(data, schema="k int, v string"):
        return spark.createDataFrame(data, schema)

    days = [f"2025-01-0{d} 00:00:00" for d in range(1, 6)]
    table().run(load([(1, "a"), (2, "b")]), days[0])
    assert table().run(load([(1, "A"), (3, "c")]), days[1]) == 2
    once = rows(table().read())
    assert table().run(load([(9, "never seen")]), days[1]) == 2
    assert rows(table().read()) == once and len(once) == 4
    table().run(load([(1, "A"), (3, "c")]), days[2])
    assert rows(table().read()) == once
    wider = load([(1, "A", 5), (3, "c", 6)], "k int, v string, n int")
    with pytest.raises(ValueError, match="lacks"):
        table().run(wider, days[3])
    table(on_new_column="add").run(wider, days[4])
    got = table().read()
    assert got.where("n is not null").count() == 2 and got.count() == 6
