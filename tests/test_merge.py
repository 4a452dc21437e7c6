"""Keys, duplicates and merges on tiny tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.keys import dedupe, key_violations, pair_by_key
from tidemark.operators.merge import merge, merge_stats

SCHEMA = "k int, a string, b int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


T0 = [(1, "one", 10), (2, "two", 20), (None, "lost", 0)]
S0 = [(2, "TWO", 21), (3, "three", 30), (None, "new", 9)]


@pytest.mark.parametrize(
    "mode, want",
    [
        ("delete_insert", [(1, "one", 10), (None, "lost", 0), *S0]),
        ("upsert", [(1, "one", 10), (None, "lost", 0), *S0]),
        ("insert_ignore", [*T0, (3, "three", 30), (None, "new", 9)]),
        ("full_sync", S0),
    ],
)
def test_modes(spark, mode, want):
    out = merge(table(spark, T0), table(spark, S0), "k", mode)
    assert got(out) == sorted(want, key=repr)


@pytest.mark.parametrize("mode", ["delete_insert", "upsert", "insert_ignore"])
def test_empty_stage_changes_nothing(spark, mode):
    assert got(merge(table(spark, T0), table(spark, []), "k", mode)) == sorted(T0, key=repr)


@pytest.mark.parametrize("mode", ["delete_insert", "upsert", "insert_ignore", "full_sync"])
def test_empty_target_takes_the_stage(spark, mode):
    assert got(merge(table(spark, []), table(spark, S0), "k", mode)) == sorted(S0, key=repr)


def test_full_sync_with_empty_stage_deletes_all(spark):
    assert got(merge(table(spark, T0), table(spark, []), "k", "full_sync")) == []


@pytest.mark.parametrize("mode", ["upsert", "insert_ignore", "full_sync", "incremental"])
def test_merging_twice_is_merging_once(spark, mode):
    keyed = [r for r in S0 if r[0] is not None]
    stage = table(spark, keyed)
    once = merge(table(spark, T0), stage, "k", mode, run_ts="2025-01-01")
    twice = merge(once, stage, "k", mode, run_ts="2025-01-01")
    if mode == "incremental":  # a row inserted the first time is stamped the second time
        once, twice = once.drop("updated_at"), twice.drop("updated_at")
    assert got(twice) == got(once)


def test_columns_match_by_name(spark):
    stage = table(spark, [(99, 2, "TWO")], "b int, k int, a string")
    assert (2, "TWO", 99) in got(merge(table(spark, T0), stage, "k", "upsert"))


def test_stage_lacks_a_column(spark):
    stage = table(spark, [(2, "TWO"), (3, "three")], "k int, a string")
    out = got(merge(table(spark, T0), stage, "k", "upsert"))
    assert (2, "TWO", 20) in out and (3, "three", None) in out and len(out) == 4


def test_full_sync_carries_target_only_columns(spark):
    stage = table(spark, [(2, "TWO"), (3, "three")], "k int, a string")
    assert got(merge(table(spark, T0), stage, "k", "full_sync")) == [
        (2, "TWO", 20),
        (3, "three", None),
    ]


def test_extra_staged_column_is_dropped(spark):
    stage = table(spark, [(1, "x", 1, 7)], "k int, a string, b int, extra int")
    assert merge(table(spark, T0), stage, "k", "upsert").columns == ["k", "a", "b"]


def test_rules(spark):
    out = merge(
        table(spark, T0),
        table(spark, S0),
        "k",
        "upsert",
        rules={"a": "target", "b": F.lit(-1)},
    )
    assert (2, "two", -1) in got(out) and (3, "three", 30) in got(out)


def test_unknown_rule_and_mode(spark):
    with pytest.raises(ValueError):
        merge(table(spark, T0), table(spark, S0), "k", "upsert", rules={"a": "mine"})
    with pytest.raises(ValueError):
        merge(table(spark, T0), table(spark, S0), "k", "sideways")
    with pytest.raises(ValueError):
        merge(table(spark, T0), table(spark, S0), "nokey", "upsert")


DUP = [(2, "old", 1), (2, "new", 2), (3, "x", 1)]


def test_duplicates_fail_by_default(spark):
    with pytest.raises(Exception, match="duplicate key"):
        merge(table(spark, T0), table(spark, DUP), "k", "upsert").collect()


def test_duplicates_latest(spark):
    out = merge(table(spark, T0), table(spark, DUP), "k", "upsert", "latest", "b")
    assert (2, "new", 2) in got(out) and (2, "old", 1) not in got(out)


def test_duplicates_kept_by_delete_insert(spark):
    out = merge(table(spark, T0), table(spark, DUP), "k", "delete_insert", "keep")
    assert {(2, "old", 1), (2, "new", 2)} <= set(got(out))


def test_only_some_modes_keep_repeats(spark):
    for mode in ("upsert", "full_sync", "incremental", "versioned"):
        with pytest.raises(ValueError):
            merge(table(spark, T0), table(spark, DUP), "k", mode, "keep", run_ts="2025-01-01")


def test_latest_needs_an_order(spark):
    with pytest.raises(ValueError):
        merge(table(spark, T0), table(spark, DUP), "k", "upsert", "latest")


def test_equal_order_values_pick_the_same_row_every_time(spark):
    rows = [(1, c, 5) for c in "abcdef"]
    for n in (1, 3, 6):
        df = table(spark, rows).repartition(n)
        assert got(dedupe(df, "k", "b")) == [(1, "f", 5)]


def test_null_part_of_a_composite_key_never_matches(spark):
    schema = "k1 int, k2 string, v int"
    target = table(spark, [(1, None, 1), (1, "a", 1)], schema)
    stage = table(spark, [(1, None, 2), (1, "a", 2)], schema)
    out = got(merge(target, stage, ["k1", "k2"], "upsert"))
    assert out == sorted([(1, None, 1), (1, None, 2), (1, "a", 2)], key=repr)


def test_dedupe_keeps_null_keys(spark):
    rows = [(None, "a", 1), (None, "b", 2), (1, "c", 1), (1, "d", 2)]
    assert got(dedupe(table(spark, rows), "k", "b")) == sorted(
        [(None, "a", 1), (None, "b", 2), (1, "d", 2)], key=repr
    )


def test_key_only_table(spark):
    out = merge(
        table(spark, [(1,), (2,)], "k int"), table(spark, [(2,), (3,)], "k int"), "k", "upsert"
    )
    assert got(out) == [(1,), (2,), (3,)]


def test_incremental_stamps_matched_rows_only(spark):
    run_ts = dt.datetime(2025, 1, 2, 3, 4, 5)
    out = merge(table(spark, T0), table(spark, S0), "k", "incremental", run_ts=run_ts)
    stamps = {r["a"]: r["updated_at"] for r in out.collect()}
    assert stamps == {"one": None, "lost": None, "TWO": run_ts, "three": None, "new": None}
    with pytest.raises(ValueError):
        merge(table(spark, T0), table(spark, S0), "k", "incremental")


def test_versioned_keeps_created_at_and_id(spark):
    schema = "k int, id int, created_at string, v int, source_version long"
    target = table(spark, [(1, 100, "then", 1, 5)], schema)
    stage = table(spark, [(1, 7, "now", 2, 9), (2, 8, "now", 3, 9)], schema)
    out = merge(target, stage, "k", "versioned", run_ts="2025-01-01")
    rows = {r["k"]: r for r in out.collect()}
    assert tuple(rows[1])[:5] == (1, 100, "then", 2, 9) and rows[1]["updated_at"] is not None
    assert tuple(rows[2])[:5] == (2, 8, "now", 3, 9) and rows[2]["updated_at"] is None


def test_stats(spark):
    target = table(spark, [(1, "a", 1), (2, "b", 2), (3, None, 3), (None, "n", 0)])
    stage = table(spark, [(2, "b", 2), (3, "c", 3), (4, "d", 4), (None, "n", 0)])
    row = merge_stats(target, stage, "k").first().asDict()
    assert row == {
        "staged": 4, "before": 4, "inserted": 2, "updated": 1, "unchanged": 1, "not_staged": 2,
        "after": 6, "merged": 2,
    }


def test_key_violations(spark):
    df = table(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4), (None, "e", 5)])
    assert got(key_violations(df, "k")) == sorted(
        [(1, 2, "duplicate"), (None, 2, "null")], key=repr
    )


def test_pairs_reject_repeats_instead_of_multiplying(spark):
    one, two = table(spark, [(1, "a", 1)]), table(spark, [(1, "b", 1), (1, "c", 2)])
    for nulls_match in (True, False):
        with pytest.raises(Exception, match="duplicate key"):
            pair_by_key(one, two, "k", nulls_match).collect()


def test_pairs_and_null_keys(spark):
    a, b = table(spark, [(None, "a", 1)]), table(spark, [(None, "b", 2)])
    assert pair_by_key(a, b, "k", nulls_match=True).count() == 1
    assert pair_by_key(a, b, "k").count() == 2


KEYS = st.one_of(st.none(), st.integers(0, 5))
ROWS = st.lists(st.tuples(KEYS, st.sampled_from("xyz"), st.integers(0, 3)), max_size=8)


def by_hand(target, stage, mode):
    """The merge as a loop over rows."""
    newest = {}
    for r in sorted((r for r in stage if r[0] is not None), key=lambda r: (r[2], r[1])):
        newest[r[0]] = r
    rows = list(newest.values()) + [r for r in stage if r[0] is None]
    have = {r[0] for r in target if r[0] is not None}
    if mode == "full_sync":
        return rows
    if mode == "insert_ignore":
        return target + [r for r in rows if r[0] is None or r[0] not in have]
    return [r for r in target if r[0] is None or r[0] not in newest] + rows


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=ROWS, stage=ROWS, mode=st.sampled_from(["upsert", "insert_ignore", "full_sync"]))
def test_merge_equals_a_loop_over_rows(spark, target, stage, mode):
    out = merge(table(spark, target), table(spark, stage), "k", mode, "latest", "b")
    assert got(out) == sorted(by_hand(target, stage, mode), key=repr)
