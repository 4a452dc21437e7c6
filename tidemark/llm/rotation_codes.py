"""Near-duplicate vectors by randomly rotated binary codes with correction factors.

A unit vector x is rotated at random and keeps the signs of its D coordinates, a code c, and the factor
f = <c, x> / sqrt(D). For any unit y, <c, y> / (sqrt(D) f) estimates <x, y> without bias, with an
error of about sqrt((1 - f^2) / f^2 / (D - 1)). A pair is recomputed exactly, in double precision,
unless its estimate plus ``SIGMAS`` errors stays below the threshold; no pair is linked unseen.

Pairs meet in buckets: ``tables`` keys of ``bits`` bits each, from the codes of further rotations. The
number of bits follows the number of vectors (buckets of about ``BUCKET``), the number of tables follows from the
bits so that two vectors at the threshold meet with probability 1 - ``MISS`` at least, closer ones with more.
Equal vectors are one row with a weight. A pair is counted in the first table in which it
meets, so nothing but sums per vector and one edge per vector and bucket leaves a bucket.
Buckets above ``BLOCK`` rows are split into blocks that meet block by block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, saved

BUCKET = 64
BLOCK = 2_048
MISS = 0.005
SIGMAS = 5.0
PAIRS = 100_000


def shape(n: int, threshold: float) -> tuple[int, int]:
    """Bits and number of tables for ``n`` vectors."""
    bits = max(4, min(31, math.ceil(math.log2(max(1, n / BUCKET)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-agree)))


@lru_cache(maxsize=8)
def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random rotations of ``dim`` dimensions side by side, always the same ones."""
    rng = np.random.default_rng(dim)
    parts = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts, axis=1)


def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(vec_id, embedding) -> the vector's bytes and their hash; NULL for what links with nothing."""
    for batch in batches:
        keys, data = [], []
        for e in batch["embedding"]:
            v = None
            if e is not None and len(e):
                v = np.asarray([np.nan if x is None else x for x in e], np.float64)
                v = v if np.isfinite(v).all() and np.isfinite(v @ v) and v @ v > 0 else None
            raw = None if v is None else v.tobytes()
            data.append(raw)
            keys.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
        yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "hash": keys, "vec": data})


def unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def keyed(bits: int, tables: int):
    """(rep, weight, vec) -> one row per table with the bucket, all keys, the code and its factor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            for size, part in batch.groupby(batch["vec"].str.len()):
                dim = size // 8
                x = unit(list(part["vec"]))
                # The first rotation makes the code, the others the keys.
                turned = x @ rotations(dim, 1 + -(-bits * tables // dim))
                signs = turned > 0
                keys = signs[:, dim : dim + bits * tables].reshape(len(part), tables, bits) @ powers
                factor = np.abs(turned[:, :dim]).sum(1) / math.sqrt(dim)
                code = np.packbits(signs[:, :dim], axis=1)
                packed = keys.astype(np.int32)
                for t in range(tables):
                    yield pd.DataFrame(
                        {
                            "dim": np.full(len(part), dim, np.int32),
                            "t": np.full(len(part), t, np.int32),
                            "key": keys[:, t],
                            "rep": part["rep"].to_numpy(),
                            "weight": part["weight"].to_numpy(),
                            "vec": part["vec"].to_numpy(),
                            "keys": [k.tobytes() for k in packed],
                            "code": [c.tobytes() for c in code],
                            "factor": factor,
                        }
                    )

    return run


def candidate_pairs(x, code, factor, threshold: float, one, two):
    """Pairs of rows (i of ``one``, j of ``two``, i < j) that the estimate can't rule out."""
    dim = x.shape[1]
    signs = np.unpackbits(code, axis=1)[:, :dim].astype(np.float32) * 2 - 1
    turned = (x @ rotations(dim, 1)[:, :dim]).astype(np.float32)
    scale = 1 / (factor * math.sqrt(dim))
    error = SIGMAS * np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, dim - 1))
    least = (threshold - error) / scale
    estimate = signs[one] @ turned[two].T
    i, j = np.nonzero(estimate >= least[one][:, None].astype(np.float32) - 1e-4)
    i, j = one[i], two[j]
    lower = i < j
    return i[lower], j[lower]


def links_of(group: dict, threshold: float):
    """(rep, links, root) for the rows of one bucket or pair of blocks that have a link."""
    t, reps, weight = int(group["t"][0]), group["rep"], group["weight"]
    raw = np.frombuffer(b"".join(group["vec"]), np.float64).reshape(len(reps), -1)
    norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    code = np.frombuffer(b"".join(group["code"]), np.uint8).reshape(len(reps), -1)
    keys = np.frombuffer(b"".join(group["keys"]), np.int32).reshape(len(reps), -1)
    side = group["block"]
    every = np.arange(len(reps))
    low, high = group["low"][0], group["high"][0]
    if low == high:
        one = two = every
        i, j = candidate_pairs(raw / norm[:, None], code, group["factor"], threshold, one, two)
    else:
        one, two = every[side == low], every[side == high]
        if not len(one) or not len(two):
            return None
        # Rows are ordered by block, so the pairs are i < j as well.
        i, j = candidate_pairs(raw / norm[:, None], code, group["factor"], threshold, one, two)
    kept = []
    for k in range(0, len(i), PAIRS):
        a, b = i[k : k + PAIRS], j[k : k + PAIRS]
        cosine = np.einsum("ij,ij->i", raw[a], raw[b]) / (norm[a] * norm[b])
        linked = cosine >= threshold
        kept.append((a[linked], b[linked]))
    if not kept:
        return None
    i, j = (np.concatenate(p) for p in zip(*kept, strict=True))
    if not len(i):
        return None
    new = np.ones(len(i), bool)
    for k in range(0, len(i), PAIRS):
        a, b = i[k : k + PAIRS], j[k : k + PAIRS]
        new[k : k + PAIRS] = ~(keys[a, :t] == keys[b, :t]).any(axis=1)
    count = np.bincount(i[new], weight[j[new]], len(reps)) + np.bincount(j[new], weight[i[new]], len(reps))
    root = reps.copy()
    while True:
        least = np.minimum(root[i], root[j])
        if (root[i] == least).all() and (root[j] == least).all():
            break
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
    touched = np.unique(np.concatenate([i, j]))
    return pd.DataFrame(
        {"rep": reps[touched], "links": count[touched].astype(np.int64), "root": root[touched]}
    )


GROUP = ["dim", "t", "key", "low", "high"]


def bucketed(threshold: float):
    """Rows sorted by bucket -> :func:`links_of` of each; holds one bucket at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def close():
            rows = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            if len(rows) > 1:
                found = links_of({c: rows[c].to_numpy() for c in rows.columns}, threshold)
                if found is not None:
                    yield found

        last = None
        for batch in batches:
            marks = batch[GROUP].to_numpy()
            cut = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(batch)], strict=True):
                if a == b:
                    continue
                name = tuple(marks[a])
                if last is not None and name != last:
                    yield from close()
                    held = []
                held.append(batch.iloc[a:b])
                last = name
        if held:
            yield from close()

    return run


def near_vectors(embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``embeddings(vec_id, embedding)``.

    Vectors are linked when their cosine in double precision is at least ``threshold``. NULL,
    empty and zero vectors and those with NULL or non-finite components link with nothing; nor
    do vectors of different lengths. Equal vectors of different ids are linked. Repeated rows
    stay repeated and count once; different vectors of one id are one node of a component. Rows
    with a NULL id link with nothing and have a NULL component. Other columns are ignored; an
    empty table gives an empty result.
    """
    rows = saved(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        ).mapInPandas(vectors, "vec_id bigint, hash binary, vec binary"),
        "vectors",
    )
    named = rows.where("vec_id is not null and hash is not null")
    distinct = named.groupBy("hash", "vec_id").agg(F.first("vec").alias("vec"))
    reps = saved(
        distinct.groupBy("hash").agg(
            F.xxhash64("hash").alias("rep"),
            F.min("vec_id").alias("least_id"),
            F.count("vec_id").alias("weight"),
            F.first("vec").alias("vec"),
        ),
        "distinct-vectors",
    )
    bits, tables = shape(reps.count(), threshold)
    entries = reps.select("rep", "weight", "vec").mapInPandas(
        keyed(bits, tables),
        "dim int, t int, key bigint, rep bigint, weight bigint, vec binary, keys binary, code binary, factor double",
    )
    entries = saved(entries, "codes")
    hot = entries.groupBy("dim", "t", "key").count().where(F.col("count") > BLOCK).select(
        "dim", "t", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")
    )
    blocked = (
        entries.join(hot, ["dim", "t", "key"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("parts", "other")
    )
    found = saved(
        blocked.repartition(*GROUP)
        .sortWithinPartitions(*GROUP, "block", "rep")
        .mapInPandas(bucketed(threshold), "rep bigint, links bigint, root bigint"),
        "links",
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    several = distinct.groupBy("vec_id").agg(F.min("hash").alias("one"), F.max("hash").alias("last"))
    same = several.where("one <> last").join(distinct, "vec_id").select(
        F.xxhash64("one").alias("a"), F.xxhash64("hash").alias("b")
    )
    joined = components(
        found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(same)
    ).select(F.col("id").alias("rep"), F.col("component_id").alias("c"))
    of_reps = saved(
        reps.drop("vec").join(joined, "rep", "left").join(counts, "rep", "left").select(
            "hash",
            "least_id",
            F.coalesce("c", "rep").alias("c"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "vector-nodes",
    )
    least = of_reps.groupBy("c").agg(F.min("least_id").alias("component_id"))
    of_reps = of_reps.join(least, "c").select("hash", "n_links", "component_id")
    return (
        rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("hash")).alias("hash"))
        .join(of_reps, "hash", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
        )
    )
