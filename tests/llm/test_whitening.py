"""Whitened vectors against exact sums and a full eigenvalue decomposition."""

import math

import numpy as np
import pytest

from tidemark.llm.common import table
from tidemark.llm.queries import op13_whitening
from tidemark.llm.whitening import components, eigen, fit, leading_values, tridiagonal, whitened


def reference(rows, count=8):
    """(id, component) -> (n, deviation, whitened, explained), up to the sign of a component."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(v[j] for v in x) for j in range(d)]
    c = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    out = {}
    for (key, _), v, row in zip(rows, x, c, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        for k in range(len(values)):
            if values[k] > 1e-9:
                out[key, k + 1] = (n, deviation, row @ axes[:, k] / math.sqrt(values[k]), values[k] / np.trace(c.T @ c / n))
    return out


def compare(got, want):
    assert {(r[0], r["component"]) for r in got} == set(want)
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        n, deviation, w, explained = want[r[0], r["component"]]
        assert r["n"] == n and r["deviation"] == deviation
        assert abs(r["explained"] / explained - 1) < 1e-9
        sign = signs.setdefault(r["component"], np.sign(w * r["whitened"]))
        assert abs(sign * r["whitened"] - w) < 1e-7, (r, w)
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("n", [1, 2, 3, 9, 64])
def test_eigenvalues_and_vectors(n):
    rng = np.random.default_rng(n)
    full = rng.normal(size=(n, n))
    turned = np.linalg.qr(full)[0]
    low = rng.normal(size=(n, 2))
    for a in (
        full @ full.T, np.eye(n) * 3, np.zeros((n, n)), low @ low.T * 1e5,
        turned @ np.diag(np.resize([5.0, 2.0, 2 - 1e-9], n)) @ turned.T,
        np.diag(np.arange(n, dtype=float)),
    ):
        a = (a + a.T) / 2
        values, vectors = eigen(a, 8)
        want = np.linalg.eigvalsh(a)[::-1][:8]
        size = max(1.0, np.abs(want).max())
        assert np.abs(values - want).max() < 1e-13 * size
        assert np.abs(vectors @ a - values[:, None] * vectors).max() < 1e-12 * size
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13


def test_tridiagonal_keeps_eigenvalues():
    a = np.random.default_rng(3).normal(size=(20, 20))
    a = a + a.T
    d, e, _ = tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.abs(np.linalg.eigvalsh(t) - np.linalg.eigvalsh(a)).max() < 1e-12
    assert np.abs(leading_values(d, e, 20) - np.linalg.eigvalsh(a)[::-1]).max() < 1e-12


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    got = op13_whitening(spark, sf_dir)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    compare(got.collect(), reference(good))


def test_awkward_vectors(spark):
    """NULL, empty, ragged and non-finite vectors, repeated rows, NULL keys, clashing columns."""
    nan, inf = float("nan"), float("inf")
    good = [(i, [i * 0.5, -i * 1.25, (i * i) % 7 + 0.1, 3.0]) for i in range(30)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [nan, 1.0, 1.0, 1.0]), (104, [inf, 1.0, 1.0, 1.0]),
           (105, [1.0, 2.0, 3.0]), (106, [1.0] * 5), (107, [1e300, 0.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>, whitened string, n int, x int"
    df = spark.createDataFrame([(*r, "a", 1, 2) for r in good + bad], schema)
    compare(components(df).collect(), reference(good))
    w, x = fit(df)
    kept = whitened(x, w).select("vec_id", "n", "x").collect()
    assert sorted(map(tuple, kept)) == [(i, 1, 2) for i in range(30)]
    twice = components(df.unionByName(df.where("vec_id < 3")))
    assert twice.where("vec_id = 1 and component = 1").count() == 2 and twice.first()["n"] == 33
    unnamed = components(spark.createDataFrame([(None, v) for _, v in good], "vec_id long, embedding array<double>"))
    assert unnamed.where("vec_id is null").count() == 60  # two directions vary


def test_nothing_varies(spark):
    schema = "vec_id long, embedding array<float>"
    assert components(spark.createDataFrame([], schema)).collect() == []
    assert components(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert components(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []


def test_large_entries_are_exact(spark):
    """Sums and deviations beyond 64 bits."""
    rows = [(i, [float(2**50 * (i % 3)), float(i)]) for i in range(9)]
    w, x = fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=2)
    fixed = [[int(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(v[j] for v in fixed) for j in range(2)]
    assert w.sums == sums
    got = {r["vec_id"]: int(r["deviation"]) for r in whitened(x, w).collect() if r["deviation"] is not None}
    for i, v in enumerate(fixed):
        want = sum((9 * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        assert got.get(i, want) == want


def test_too_many_dimensions(spark):
    with pytest.raises(ValueError, match="max_dims"):
        fit(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>"), max_dims=2)
