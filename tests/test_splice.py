"""Late loads in histories, and as-of joins, against plain Python."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators.asof import as_of_join

SCHEMA = "k string, v int"


def hour(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def spliced(spark, loads, order, schema=SCHEMA):
    history, seen = None, []
    for n in order:
        rows = spark.createDataFrame(loads[n], schema)
        history = H.splice_load(history, rows, "k", hour(n), H.next_load(seen, hour(n)))
        seen.append(hour(n))
    return rows_of(history)


def in_order(spark, loads):
    history = None
    for n in sorted(loads):
        rows = spark.createDataFrame(loads[n], SCHEMA)
        history = H.snapshot(history, rows, "k", "check", hour(n), hard_deletes=True)
    return rows_of(history)


def test_any_order_of_three_loads_gives_one_history(spark):
    """Every key of the 27 ways to be absent, of one value or of another in three loads."""
    states = [None, 1, 2]
    keys = {f"k{i}": s for i, s in enumerate(itertools.product(states, repeat=3))}
    loads = {n: [(k, s[n]) for k, s in keys.items() if s[n] is not None] for n in range(3)}
    want = in_order(spark, loads)
    for order in itertools.permutations(range(3)):
        assert spliced(spark, loads, order) == want, order


@pytest.mark.parametrize("seed", [1])
def test_random_orders_of_five_loads(spark, seed):
    r = random.Random(seed)
    loads = {n: [(f"k{i}", r.choice([1, 2, None])) for i in range(40) if r.random() < 0.7] for n in range(5)}
    order = list(range(5))
    r.shuffle(order)
    assert spliced(spark, loads, order) == in_order(spark, loads)


def test_a_load_again_changes_nothing(spark):
    loads = {0: [("a", 1), ("b", 1)], 1: [("a", 2)], 2: [("a", 2), ("b", 3)]}
    history = None
    for n in (0, 2, 1):
        history = H.splice_load(history, spark.createDataFrame(loads[n], SCHEMA), "k", hour(n), hour(2) if n == 1 else None)
    again = H.splice_load(history, spark.createDataFrame(loads[1], SCHEMA), "k", hour(1), hour(2))
    assert rows_of(again) == rows_of(history)


def test_null_keys_and_repeats(spark):
    loads = {0: [(None, 1), ("a", 1)], 1: [(None, 2), (None, 3)], 2: [(None, 4)]}
    assert spliced(spark, loads, (0, 2, 1)) == in_order(spark, loads)
    with pytest.raises(Exception, match="duplicate key"):
        spliced(spark, {0: [("a", 1)], 1: [("a", 1), ("a", 2)]}, (0, 1))


def test_other_versions_are_not_touched(spark, tmp_path):
    """Only what lies around the load, by filters that reach the file."""
    loads = {n: [("a", n), ("b", 0)] for n in range(6)}
    history = None
    for n in range(6):
        history = H.snapshot(history, spark.createDataFrame(loads[n], SCHEMA), "k", "check", hour(n), hard_deletes=True)
    history.write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    late = spark.createDataFrame([("a", 9), ("b", 0)], SCHEMA)
    after = H.splice_load(stored, late, "k", hour(2.5), hour(3))
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(scd_valid_from" in plan and "scd_valid_from,2024-01-01" in plan
    want = set(rows_of(stored)) - {("a", 2, hour(2), hour(3), hour(2))}
    assert set(rows_of(after)) == want | {("a", 2, hour(2), hour(2.5), hour(2)), ("a", 9, hour(2.5), hour(3), hour(2.5))}


def test_rows_by_their_time_in_any_order(spark):
    r = random.Random(4)
    rows = [(f"k{r.randrange(5)}", n, hour(n)) for n in range(60)] + [(None, 1, hour(3))]
    schema = "k string, v int, at timestamp_ntz"
    want = []
    for k in {x[0] for x in rows}:
        own = sorted((x for x in rows if x[0] == k), key=lambda x: x[2])
        ends = [x[2] for x in own[1:]] + [None]
        want += [(*x, x[2], end, x[2]) for x, end in zip(own, ends, strict=True)]
    for seed in range(2):
        left, history = list(rows), None
        random.Random(seed).shuffle(left)
        while left:
            load, rest = {}, []
            for x in left:
                if x[0] in load or len(load) == 4:
                    rest.append(x)
                else:
                    load[x[0]] = x
            left = rest
            history = H.splice_rows(history, spark.createDataFrame(list(load.values()), schema), "k", "at")
            history = spark.createDataFrame(history.collect(), history.schema)  # a short plan
        assert rows_of(history) == sorted(want, key=repr)
    again = H.splice_rows(history, spark.createDataFrame([rows[7]], schema), "k", "at")
    assert rows_of(again) == sorted(want, key=repr)
    with pytest.raises(Exception, match="at is NULL"):
        H.splice_rows(history, spark.createDataFrame([("x", 1, None)], schema), "k", "at").collect()


def as_of_by_hand(facts, versions, until=False):
    out = []
    for f in facts:
        best = None
        for v in versions:
            if f[1] is not None and f[2] is not None and v[0] == f[1] and v[1] is not None and v[1] <= f[2]:
                if best is None or (v[1], v[2] is not None, v[2] or 0, v[3]) > (best[1], best[2] is not None, best[2] or 0, best[3]):
                    best = v
        if best and until and best[2] is not None and best[2] <= f[2]:
            best = None
        out.append((*f, *(best[1:] if best else (None,) * 3)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("buckets,until", [(1, False), (3, True), (64, False)])
def test_as_of_join(spark, buckets, until):
    r = random.Random(buckets)
    # A third of all with one key; keys on one side only; NULL keys and times; ties; repeated rows.
    pick = lambda: r.choice(["hot", f"k{r.randrange(6)}", f"x{r.randrange(40)}"])
    facts = [(i // 2, pick(), r.randrange(100)) for i in range(300)] + [(900, None, 5), (901, "hot", None), (902, "k1", -5)]
    versions = [(pick(), (t := r.randrange(100)), r.choice([None, t + r.randrange(30)]), i) for i in range(150)]
    versions += [(None, 3, None, 900), ("hot", None, None, 901)]
    f = spark.createDataFrame(facts, "id int, k string, at long")
    v = spark.createDataFrame(versions, "k string, since long, until long, v int")
    got = as_of_join(f, v, "k", "at", "since", "until" if until else None, buckets=buckets)
    assert got.columns == ["id", "k", "at", "since", "until", "v"]
    assert rows_of(got) == as_of_by_hand(facts, versions, until)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(10,2)"])
def test_as_of_types(spark, kind):
    f = spark.range(50).selectExpr("id", "id % 3 AS k", "id AS n")
    cast = {
        "date": "date_add(DATE'2000-01-01', CAST(n AS INT))",
        "timestamp": "timestamp_seconds(n)",
        "timestamp_ntz": "CAST(timestamp_seconds(n) AS TIMESTAMP_NTZ)",
    }.get(kind, f"CAST(n / 4 AS {kind})")
    facts = f.selectExpr("id", "k", f"{cast} AS at")
    versions = f.where("id % 7 = 0").selectExpr("k", f"{cast} AS since", "n AS v")
    got = {r["id"]: r["v"] for r in as_of_join(facts, versions, "k", "at", "since", buckets=5).collect()}
    for i in range(50):
        assert got[i] == max((v for v in range(0, i + 1, 7) if v % 3 == i % 3), default=None)


def test_as_of_empty_and_clashing(spark):
    f = spark.createDataFrame([(1, "a", 5)], "id int, k string, at long")
    v = spark.createDataFrame([("a", 3, 1)], "k string, since long, id int")
    with pytest.raises(ValueError, match="prefix"):
        as_of_join(f, v, "k", "at", "since")
    assert rows_of(as_of_join(f, v, "k", "at", "since", prefix="p_")) == [(1, "a", 5, 3, 1)]
    assert rows_of(as_of_join(f.limit(0), v, "k", "at", "since", prefix="p_")) == []
    assert rows_of(as_of_join(f, v.limit(0), "k", "at", "since", prefix="p_")) == [(1, "a", 5, None, None)]
    with pytest.raises(TypeError, match="can't compare"):
        as_of_join(f, v.withColumn("since", F.lit("x")), "k", "at", "since", prefix="p_")


def test_a_hot_key_is_spread(spark):
    """Both sides of one key: what a task orders is a bucket's share."""
    f = spark.range(4_000).selectExpr("id", "'hot' AS k", "id * 2 AS at")
    v = spark.range(4_000).selectExpr("'hot' AS k", "id * 2 - 1 AS since", "id AS v")
    got = as_of_join(f, v, "k", "at", "since", buckets=64)
    assert got.where("v = id").count() == 4_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("hashpartitioning(__k0") >= 1 and "__bucket" in plan
