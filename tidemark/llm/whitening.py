"""Whitening of embeddings by the leading eigenvectors of their covariance.

Entries are fixed-point numbers, so counts, sums and deviations are exact. One pass adds up the
vectors, a second one the products of centred entries: a task keeps one d x d matrix and hands out its rows, Spark adds them up.
The driver holds the covariance alone (d x d, ``max_dims`` bounds it) and takes it apart: Householder reflections make it
tridiagonal, counting sign changes of the Sturm sequence while halving intervals gives the leading eigenvalues,
inverse iteration their vectors, each orthogonalised against those of eigenvalues close by. Mean and components are broadcast, and every
vector is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 8
SCALE, SHIFT = 1_024, 100_000
# Up to here a fixed-point entry fits 64 bits with room for the shift.
MOST = float(2**62 // SCALE)
MAX_DIMS = 4_096
EPS = np.finfo(float).eps


# ---------------------------------------------------------------- eigenvalues of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and reflections: Q' A Q = T with Q = H1 H2 ..., Hk = I - 2 v v'."""
    a = np.array(matrix, float)
    n = len(a)
    mirrors: list[np.ndarray | None] = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.sqrt(x @ x)
        v = None
        if np.abs(x[1:]).any():
            v = x.copy()
            v[0] += np.copysign(size, x[0])
            v /= np.sqrt(v @ v)
            rest = a[k + 1 :, k + 1 :]
            w = rest @ v
            w -= (v @ w) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
            a[k + 2 :, k] = a[k, k + 2 :] = 0
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def unmirrored(y: np.ndarray, mirrors: list[np.ndarray | None]) -> np.ndarray:
    """Q y: a vector of the tridiagonal matrix as one of the whole matrix."""
    y = y.copy()
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        if v is not None:
            y[k + 1 :] -= 2 * (v @ y[k + 1 :]) * v
    return y


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: negative terms of the Sturm sequence."""
    least = np.finfo(float).tiny / EPS
    count = np.zeros(len(at), int)
    q = np.ones(len(at))
    for k in range(len(d)):
        q = d[k] - at - (e[k - 1] ** 2 / q if k else 0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues in falling order; all intervals are halved at the same time."""
    n = len(d)
    reach = np.abs(np.append(e, 0)) + np.abs(np.append(0, e)) if n > 1 else np.zeros(1)
    reach = reach + EPS * max(np.abs(d).max(), reach.max()) * n
    low, high = np.full(wanted, (d - reach).min()), np.full(wanted, (d + reach).max())
    place = n - 1 - np.arange(wanted)  # from the smallest, 0
    while True:
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high)).all():
            return mid
        up = below(d, e, mid) <= place
        low, high = np.where(up, mid, low), np.where(up, high, mid)


def solved(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b, by elimination with row exchanges; a vanishing pivot counts as ``least``."""
    n = len(d)
    main, up, up2, b = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for k in range(n - 1):
        under = e[k]
        if abs(main[k]) < abs(under):
            main[k], under = under, main[k]
            up[k], main[k + 1] = main[k + 1], up[k]
            up2[k], up[k + 1] = up[k + 1], 0.0
            b[k], b[k + 1] = b[k + 1], b[k]
        if main[k] == 0:
            main[k] = least
        f = under / main[k]
        main[k + 1] -= f * up[k]
        up[k + 1] -= f * up2[k]
        b[k + 1] -= f * b[k]
    x = np.zeros(n + 2)
    for k in range(n - 1, -1, -1):
        pivot = main[k] if abs(main[k]) > least else least
        x[k] = (b[k] - up[k] * x[k + 1] - up2[k] * x[k + 2]) / pivot
    return x[:n]


def eigen(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit vectors (rows) for them.

    Eigenvalues within a thousandth of the norm form a cluster: their vectors are started from different places and made
    orthogonal to the earlier ones in every step. Signs: the largest entry is positive.
    """
    n = len(matrix)
    wanted = min(wanted, n)
    d, e, mirrors = tridiagonal(matrix)
    values = leading_values(d, e, wanted)
    norm = max(np.abs(d).max(), np.abs(e).max() if n > 1 else 0.0)
    if not norm:
        return np.zeros(wanted), np.eye(n)[:wanted]
    found: list[np.ndarray] = []
    start = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            start = k
        # Equal eigenvalues are told apart by a few units in the last place.
        shift = value - (k - start) * 4 * EPS * norm
        x = np.cos(np.arange(1, n + 1) * (k + 1.0)) + 1.5
        for _ in range(6):
            x = solved(d, e, shift, x / np.abs(x).max(), EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                for other in found[start:k]:
                    x -= (other @ x) * other
            x /= np.sqrt(x @ x)
        found.append(x)
    vectors = np.array([unmirrored(x, mirrors) for x in found])
    vectors /= np.sqrt((vectors**2).sum(1))[:, None]
    signs = np.sign(vectors[np.arange(wanted), np.abs(vectors).argmax(1)])
    return values, vectors * signs[:, None]


# ---------------------------------------------------------------- passes over the vectors


class Whitening(NamedTuple):
    """What a fit leaves: bounded by the dimensions, not by the vectors."""

    n: int
    sums: list[int]  # exact
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one row per component
    identity_error: float | None


def usable(vector: str | Column) -> Column:
    """Not NULL, not empty, and every entry a finite number that fixed-point numbers can hold."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= MOST, F.lit(False))),
        F.lit(False),
    )


def fixed(vector: str | Column) -> Column:
    """Entries as whole numbers: floor(1024 c) + 100000."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def of_batch(column: pa.Array) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64, copy=False)


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per dimension, as text, and the number of vectors; one row per task and dimension."""
    n, sums = 0, None
    for batch in batches:
        if batch.num_rows:
            m = of_batch(batch.column(0))
            small = np.abs(m).max() < 2**62 // len(m)
            one = (m if small else m.astype(object)).sum(0).astype(object)
            n, sums = n + len(m), one if sums is None else sums + one
    if n:
        d = len(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d, dtype=np.int32)), pa.array([str(s) for s in sums]), pa.array([n] * d, pa.int64())],
            ["i", "s", "n"],
        )


def total(x: DataFrame, of) -> dict[int, np.ndarray]:
    """Sums over all vectors of the rows of the matrices that ``of`` makes of a batch.

    A task adds up its batches and hands out each matrix row once, whatever it has read.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for batch in batches:
            if batch.num_rows:
                one = of(of_batch(batch.column(0)))
                m = one if m is None else m + one
        if m is not None:
            for i in range(len(m)):
                row, at = m[i], np.arange(m.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), i, np.int32)), pa.array(at), pa.array(row, pa.float64())],
                    ["i", "j", "v"],
                )

    sums = x.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out: dict[int, dict[int, float]] = {}
    for r in sums.collect():
        out.setdefault(r["i"], {})[r["j"]] = r["v"]
    return {i: np.array([row[j] for j in sorted(row)]) for i, row in out.items()}


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, from the exact n x - S while that fits 64 bits."""
    if np.abs(x).max(initial=0) < 2**62 // n:
        return (n * x - sums.astype(np.int64)).astype(float) / n
    return (n * x.astype(object) - sums).astype(float) / n


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, max_dims: int = MAX_DIMS) -> tuple[Whitening | None, DataFrame]:
    """A whitening of all usable vectors, and these as ``(the other columns, x)``.

    Rows whose vector is NULL, empty, or holds a NULL, a non-finite entry or one beyond 2^52 are left out; so are vectors
    of another length than most have (ties: the longer), which lack entries or have some too many. More than
    ``max_dims`` dimensions fail. Components whose eigenvalue is no more than rounding (a direction in which nothing
    varies) are left out. Without a usable vector there is no fit (None). Repeated rows count
    each time; columns of any name stay.
    """
    spark = vectors.sparkSession
    x = vectors.where(usable(F.col(vector))).withColumn(vector, fixed(F.col(vector)))
    lengths = x.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None, x
    d = lengths["d"]
    if d > max_dims:
        raise ValueError(f"{d} dimensions; the covariance is bounded by max_dims={max_dims}")
    x = x.where(F.size(vector) == d)
    only = x.select(vector)

    exact = (
        only.mapInArrow(partial_sums, "i int, s string, n bigint")
        .groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        .orderBy("i").collect()
    )
    n, sums = exact[0]["n"], np.array([int(r["s"]) for r in exact], object)
    mean = spark.sparkContext.broadcast((n, sums))

    def products(batch: np.ndarray) -> np.ndarray:
        c = centred(batch, *mean.value)
        return c.T @ c

    rows = total(only, products)
    covariance = np.array([rows[i] for i in range(d)]) / n
    covariance = (covariance + covariance.T) / 2
    values, axes = eigen(covariance, components)
    trace = float(np.trace(covariance))
    kept = values > 8 * d * EPS * trace
    values, axes = values[kept], axes[kept]
    found = Whitening(n, list(sums), trace, values, axes, None)
    if not len(values):
        return found, x
    turned = spark.sparkContext.broadcast(found)

    def checked(batch: np.ndarray) -> np.ndarray:
        w = projected(batch, turned.value)
        return np.vstack([w.T @ w, w.sum(0)])

    rows = total(only, checked)
    k = len(values)
    means = rows[k] / n
    # Whitened values are centred before they are multiplied; what their mean is off by is rounding.
    identity = np.array([rows[i] for i in range(k)]) / n - np.outer(means, means)
    return found._replace(identity_error=float(np.abs(identity - np.eye(k)).max())), x


def projected(x: np.ndarray, w: Whitening) -> np.ndarray:
    c = centred(x, w.n, np.array(w.sums, object))
    return c @ w.vectors.T / np.sqrt(w.values)


def deviations(x: np.ndarray, w: Whitening) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact."""
    sums = np.array(w.sums, object)
    if np.abs(x).max(initial=0) < 2**62 // w.n:
        c = w.n * x - sums.astype(np.int64)
        if int(np.abs(c).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (c * c).sum(1).tolist()
        c = c.astype(object)
    else:
        c = w.n * x.astype(object) - sums
    return [int(v) for v in (c * c).sum(1)]


def whitened(x: DataFrame, w: Whitening | None, vector: str = "embedding") -> DataFrame:
    """``x`` of :func:`fit` with ``whitened`` (an array, one entry per component) and ``deviation``
    (decimal; NULL beyond 38 digits) in place of its vector."""
    kept = [c for c in x.columns if c != vector]
    if w is None:
        return x.select(*kept, F.lit(None).cast("array<double>").alias("whitened"),
                        F.lit(None).cast("decimal(38,0)").alias("deviation"))
    spark = x.sparkSession
    model = spark.sparkContext.broadcast(w)
    schema = T.StructType([
        *(T.StructField(f"c{i}", x.schema[c].dataType) for i, c in enumerate(kept)),
        T.StructField("w", T.ArrayType(T.DoubleType())),
        T.StructField("deviation", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = of_batch(batch.column(len(kept)))
            p = projected(m, model.value)
            at = np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)],
                 pa.ListArray.from_arrays(pa.array(at), pa.array(p.ravel(), pa.float64())),
                 pa.array([str(v) for v in deviations(m, model.value)])],
                [*(f"c{i}" for i in range(len(kept))), "w", "deviation"],
            )

    named = x.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(vector).alias("x"))
    return named.mapInArrow(run, schema).select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)),
        F.col("w").alias("whitened"),
        F.expr("try_cast(deviation AS DECIMAL(38,0))").alias("deviation"),
    )


def components(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``: a row per usable
    vector and component, numbered from 1.

    What :func:`fit` leaves out has no rows. ``deviation`` is NULL where it exceeds 64 bits. Repeated
    rows and keys stay, a NULL key stays NULL, an empty table or one without variance gives no
    rows. Components of equal eigenvalues are any orthonormal ones of their space.
    """
    w, x = fit(vectors.select(key, vector), vector, count)
    rows = whitened(x, w, vector)
    explained = [] if w is None else [float(v / w.trace) for v in w.values]
    share = F.element_at(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("component"))
    return rows.select(
        key, F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        F.posexplode("whitened").alias("component", "whitened"),
    ).withColumn("component", F.col("component") + 1).select(
        key, "component",
        F.lit(w.n if w else None).cast("long").alias("n"),
        "deviation", "whitened",
        share.alias("explained"),
        F.lit(w.identity_error if w else None).cast("double").alias("identity_error"),
    )
