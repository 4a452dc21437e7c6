"""Search, sort and pages."""

import random

import pytest

from tidemark.operators import paging as P


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        # A third of the rows share one value, and some have none.
        s = "hot" if i % 3 == 0 else rng.choice([None, "a", "b"]) if i % 10 == 1 else f"s{i % 400}"
        n = None if i % 17 == 0 else float("nan") if i % 101 == 0 else rng.choice([0.0, 1.5, rng.random()])
        rows.append((i, s, n))
    return rows


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "k int, s string, n double").repartition(5).cache()


def by_hand(data, column, order, skip, size):
    i = {"k": 0, "s": 1, "n": 2}[column]
    nan = lambda v: (1, 0.0) if isinstance(v, float) and v != v else (0, v)
    some = sorted((r for r in data if r[i] is not None), key=lambda r: r[0])
    some = sorted(some, key=lambda r: nan(r[i]), reverse=order == "DESC")
    none = sorted((r for r in data if r[i] is None), key=lambda r: r[0])
    rows = some + none if order == "ASC" else none + some
    return [r[0] for r in rows[skip : skip + size]]


@pytest.mark.parametrize("order", ["ASC", "DESC"])
@pytest.mark.parametrize("column", ["s", "n"])
@pytest.mark.parametrize("number", [1, 13, 20, 21])
def test_pages_near_and_far(df, data, column, order, number):
    want = by_hand(data, column, order, (number - 1) * 100, 100)
    assert [r["k"] for r in P.page(df, number, 100, column, order, "k").collect()] == want


def test_far_page_of_copies(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(2,)] * 20, "v int")
    assert [r[0] for r in P.page(df, 5, 100, "v").collect()] == [1] * 100
    assert [r[0] for r in P.page(df, 6, 100, "v").collect()] == [2] * 20
    assert [r[0] for r in P.page(df, 9, 60, "v").collect()] == [1] * 20 + [2] * 20


def test_far_text_and_key_order(df, data):
    got = [r["k"] for r in P.page(df, 38, 50, "k", "DESC").collect()]
    assert got == by_hand(data, "k", "DESC", 1850, 50)


def test_page_past_the_end(df):
    assert P.page(df, 1000, 100, "s", "ASC", "k").count() == 0


@pytest.mark.parametrize("number, size", [(0, 10), (1, 0), (1, 1001)])
def test_bad_pages(df, number, size):
    with pytest.raises(ValueError):
        P.page(df, number, size)


def test_bad_order_and_column(df):
    with pytest.raises(ValueError):
        P.page(df, 1, 10, "s", "UP")
    with pytest.raises(ValueError):
        P.page(df, 1, 10, "nope")


def test_meta(df):
    assert tuple(P.page_meta(df, 300).first()) == (2000, 7)
    assert tuple(P.page_meta(df.where("false")).first()) == (0, 0)


def test_search(spark):
    df = spark.createDataFrame([(1, "Alpha"), (2, "beta_x"), (3, "a%b"), (4, None)], "k int, t string")
    keys = lambda term: sorted(r["k"] for r in P.search(df, "t", term).collect())
    assert keys("ALPH") == [1]
    assert keys("a%a") == [1]
    assert keys("t_") == [2]
    assert keys("%") == [1, 2, 3]
    with pytest.raises(TypeError):
        P.search(df, "k", "1")


def test_keyset_pages_walk_the_whole_table(df):
    seen, last = [], None
    while True:
        rows = P.keyset_page(df, "k", last, 700).collect()
        if not rows:
            break
        seen += [r["k"] for r in rows]
        last = seen[-1]
    assert seen == list(range(2000))


def test_pages_without_a_key_are_the_table(spark):
    rows = [(i % 2, i, [i]) for i in range(900)]
    df = spark.createDataFrame(rows, "s int, v int, a array<int>").repartition(7)
    for column in ("s", None):
        seen = [tuple(r) for n in range(1, 11) for r in P.page(df, n, 100, column).collect()]
        assert sorted(seen) == sorted(rows)


def test_keyset_on_two_columns(spark):
    rows = [(i // 50, i % 50) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(3)
    seen, last = [], None
    while page := P.keyset_page(df, ["a", "b"], last, 90).collect():
        seen += [tuple(r) for r in page]
        last = seen[-1]
    assert seen == rows
    with pytest.raises(ValueError):
        P.keyset_page(df, ["a", "b"], 1)


def test_a_unique_key_is_the_only_tie_break(spark):
    rows = [(i, i % 3, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "k int, s int, other string")
    pages = [r["k"] for n in (1, 2, 3) for r in P.page(df, n, 10, "s", "DESC", "k", unique_key=True).collect()]
    assert pages == [k for k, _, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    plan = P.page(df, 2, 10, "s", "ASC", "k", unique_key=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [s#" in plan and plan.split("Sort [", 1)[1].split("]", 1)[0].count(" ASC") == 2
    with pytest.raises(ValueError, match="needs a key"):
        P.page(df, unique_key=True)
