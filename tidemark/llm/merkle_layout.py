"""Merkle manifest of a dataset, its nodes kept in van Emde Boas order.

Rows of a group, in order, are the leaves of a tree of arity 8; the groups' roots, in order, are the leaves
of one more such tree. A tree is cut into blocks, aligned subtrees of ``HEIGHT`` hash levels (512 leaves): a block is
built in one task, and the roots of the blocks are the leaves of the next round's blocks, so a tree of any size takes
log_512(n) rounds and no task holds more than a block.

Inside a block the nodes stand as one array: a tree of L levels is its upper half (L // 2 levels) followed by the lower
subtrees from left to right, each laid out in the same way. Where a node stands follows from its depth and index by
arithmetic alone (:func:`address`), for building as for fetching siblings, and every path from leaf to root
touches few stretches of memory whatever the size of a cache line is.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ranked, saved

ARITY = 8
HEIGHT = 3
WIDTH = ARITY**HEIGHT
SIZE = 32  # bytes of a digest


def joined(digests: bytes) -> bytes:
    """The digest of a run of digests, which are hashed as hex text."""
    return sha256(digests.hex().encode()).digest()


def span(levels: int) -> int:
    """Nodes of a complete tree."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes number ``index`` of a depth (0: root) stand in a tree of ``levels``."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = ARITY ** (depth - top)
    return (
        span(top)
        + index // below * span(levels - top)
        + address(levels - top, depth - top, index % below)
    )


def build(tree: bytearray, levels: int, base: int, leaves: bytes) -> bytes:
    """Lays out a tree over ``leaves`` (digests one after the other) from slot ``base`` on; its root.

    The lower subtrees first, then the upper half over the hashes of runs of their roots. Slots of
    nodes that an incomplete tree lacks stay empty.
    """
    if levels == 1:
        tree[base * SIZE : (base + 1) * SIZE] = leaves
        return leaves
    top, bottom = levels // 2, levels - levels // 2
    first, each, width = base + span(top), span(bottom), ARITY ** (bottom - 1) * SIZE
    roots = b"".join(
        build(tree, bottom, first + k * each, leaves[a : a + width])
        for k, a in enumerate(range(0, len(leaves), width))
    )
    run = ARITY * SIZE
    upper = b"".join(joined(roots[a : a + run]) for a in range(0, len(roots), run))
    return build(tree, top, base, upper)


def rows_of(tree: bytes, levels: int, leaves: int) -> list[np.ndarray]:
    """Nodes of each depth from the leaves to below the root, fetched by address."""
    slots = np.frombuffer(tree, np.uint8).reshape(-1, SIZE)
    out, n = [], leaves
    for depth in range(levels - 1, 0, -1):
        out.append(slots[address(levels, depth, np.arange(n))])
        n = -(-n // ARITY)
    return out


def siblings(rows: list[np.ndarray], leaf: int) -> list[tuple[int, bytes]]:
    """Per level from the leaf upwards: its place in its run, and the run's other digests."""
    out = []
    for nodes in rows:
        start, place = leaf // ARITY * ARITY, leaf % ARITY
        run = nodes[start : start + ARITY]
        out.append((place, run[:place].tobytes() + run[place + 1 :].tobytes()))
        leaf //= ARITY
    return out


def packed(steps: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([place, len(others) // SIZE]) + others for place, others in steps)


def unpacked(path: bytes) -> list[tuple[int, bytes]]:
    steps, at = [], 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        steps.append((place, path[at + 2 : at + 2 + n * SIZE]))
        at += 2 + n * SIZE
    return steps


def folded(digest: bytes, steps: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for place, others in steps:
        digest = joined(others[: place * SIZE] + digest + others[place * SIZE :])
    return digest


def encoded(value: Column) -> Column:
    """A field as hashed: ``-`` for NULL, else its length in UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """Hex digest of a row."""
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


LAID = T.StructType([T.StructField("tree", T.BinaryType()), T.StructField("root", T.StringType())])
PROOFS = T.ArrayType(
    T.StructType([T.StructField("proof", T.StringType()), T.StructField("root", T.StringType())])
)


def laid_out(leaves: pd.Series, levels: pd.Series) -> pd.DataFrame:
    trees, roots = [], []
    for digests, height in zip(leaves, levels, strict=True):
        tree = bytearray(span(height) * SIZE)
        roots.append(build(tree, height, 0, bytes(digests)).hex())
        trees.append(bytes(tree))
    return pd.DataFrame({"tree": trees, "root": roots})


def blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """``nodes(g, rank, group_size, digest)`` in blocks ``(g, block, group_size, n, levels, tree, root,
    leaves)``; ``leaves`` lists what is carried, in order."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "digest", *carried)))
    gathered = (
        nodes.withColumn("block", F.floor(F.col("rank") / WIDTH).cast("long"))
        .groupBy("g", "block")
        .agg(F.max("group_size").alias("group_size"), listed.alias("leaves"))
    )
    # A block that isn't the top one has its full height also where leaves are lacking.
    n = F.size("leaves")
    least = F.lit(HEIGHT + 1)
    for k in range(HEIGHT - 1, -1, -1):
        least = F.when(n <= ARITY**k, k + 1).otherwise(least)
    full = F.col("group_size") > WIDTH
    digests = F.unhex(F.array_join(F.transform("leaves", lambda x: x["digest"]), ""))
    return (
        gathered.select(
            "g", "block", "group_size", "leaves", n.alias("n"),
            F.when(full, HEIGHT + 1).otherwise(least).alias("levels"), digests.alias("digests"),
        )
        .withColumn("laid", F.pandas_udf(laid_out, LAID)("digests", "levels"))
        .select("g", "block", "group_size", "n", "levels", "laid.tree", "laid.root",
                F.transform("leaves", lambda x: x.dropFields("rank")).alias("leaves"))
    )


def forest(nodes: DataFrame, *carried: str) -> list[DataFrame]:
    """Blocks of every round, from the leaves up; written to the shared folder."""
    rounds = [saved(blocks(nodes, *carried), "merkle")]
    most = rounds[0].agg(F.max("group_size")).first()[0] or 0
    while most > WIDTH:
        most = -(-most // WIDTH)
        roots = rounds[-1].where(F.col("group_size") > WIDTH).select(
            "g", F.col("block").alias("rank"), F.ceil(F.col("group_size") / WIDTH).alias("group_size"),
            F.col("root").alias("digest"),
        )
        rounds.append(saved(blocks(roots), "merkle"))
    return rounds


def tops(rounds: list[DataFrame]) -> DataFrame:
    """``(g, subroot)``: the root of every group."""
    out = None
    for b in rounds:
        one = b.where(F.col("group_size") <= WIDTH).select("g", F.col("root").alias("subroot"))
        out = one if out is None else out.unionByName(one)
    return out


def child_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A block with the path from its root -> one row per leaf with the path from there."""
    for batch in batches:
        for r in batch.itertuples():
            rows = rows_of(r.tree, r.levels, r.n)
            yield pd.DataFrame(
                {"g": r.g, "block": r.block, "nth": np.arange(r.n), "subroot": r.subroot,
                 "path": [packed(siblings(rows, i)) + r.path for i in range(r.n)]}
            )


def steps_down(found: DataFrame) -> DataFrame:
    wanted = found.select("g", "block", "n", "levels", "tree", "path", "subroot")
    paths = wanted.mapInPandas(
        child_paths, "g string, block bigint, nth bigint, subroot string, path binary"
    )
    return paths.select("g", (F.col("block") * WIDTH + F.col("nth")).alias("block"), "subroot", "path")


def leaf_paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest blocks with ``subroot`` and ``path``: all siblings from their root upwards.
    ``above(g, path)`` says how it goes on from a group's root."""
    found = None
    for k in range(len(rounds) - 1, -1, -1):
        top = rounds[k].where(F.col("group_size") <= WIDTH).join(above, "g").withColumn("subroot", F.col("root"))
        inner = rounds[k].where(F.col("group_size") > WIDTH)
        if found is not None:
            top = top.unionByName(inner.join(saved(steps_down(found), "merkle"), ["g", "block"]))
        found = top
    return found


def proved(tree: pd.Series, levels: pd.Series, n: pd.Series, path: pd.Series, found: pd.Series) -> pd.Series:
    """Per leaf of a block the digest of its siblings, and the root its present digest leads to."""

    def of(tree, levels, n, path, found):
        rows, above = rows_of(tree, levels, n), unpacked(bytes(path))
        rest = b"".join(others for _, others in above).hex().encode()
        known: dict[bytes, bytes] = {}
        out = []
        for i in range(n):
            steps = siblings(rows, i)
            own = b"".join(others for _, others in steps).hex().encode()
            at = folded(bytes(found[i * SIZE : (i + 1) * SIZE]), steps)
            if at not in known:
                known[at] = folded(at, above)
            out.append({"proof": sha256(own + rest).hexdigest(), "root": known[at].hex()})
        return out

    return pd.Series([of(*x) for x in zip(tree, levels, n, path, found, strict=True)], dtype=object)


def manifest(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The stored manifest of ``leaves(g, by, rank, group_size, digest, ...)``: blocks of all groups'
    trees, blocks of the tree above them, and ``(g, rank, subroot)`` of the groups, ordered by ``by``."""
    carried = [c for c in leaves.columns if c not in ("rank", "group_size", "digest", "g", "by")]
    lower = forest(leaves, *carried)
    order = leaves.groupBy("g").agg(F.min("by").alias("by"))
    groups = saved(ranked(tops(lower).join(order, "g"), [], ["by"]), "groups")
    upper = forest(
        groups.select(F.lit("").alias("g"), "rank", "group_size", F.col("subroot").alias("digest"))
    )
    return lower, upper, groups


def audited(
    rows: DataFrame,
    fields: list[str],
    group: str,
    key: str,
    now: dict[str, Column] | None = None,
) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    Leaves are digests of ``fields``; within a ``group`` they ascend by ``key``, groups ascend by their
    value. ``now`` gives fields as they are found now: the row's digest with them, and the
    siblings as recorded, lead to ``folded_root``, which is the root if nothing changed.

    NULL fields have a digest of their own; a NULL group is one that comes first, NULL keys come
    first. Texts of any length are digested whole, in the JVM. Rows of equal key stand in order of
    their digests, so repeated rows are leaves each and the roots don't depend on how the table
    was read. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    now = now or {}
    leaves = rows.select(
        encoded(F.col(group)).alias("g"),
        F.col(group).alias("by"),
        F.col(key).alias("key"),
        leaf(*[F.col(f) for f in fields]).alias("digest"),
        leaf(*[now.get(f, F.col(f)) for f in fields]).alias("found"),
    )
    lower, upper, groups = manifest(
        saved(ranked(saved(leaves, "leaves"), ["g"], ["key", "digest"]), "leaves")
    )
    top = tops(upper).first()
    root = F.lit(top["subroot"] if top else None).cast("string")
    nothing = groups.select(F.lit("").alias("g"), F.lit(b"").cast("binary").alias("path")).limit(1)
    above = steps_down(leaf_paths(upper, nothing)).select(F.col("block").alias("rank"), "path")
    paths = leaf_paths(lower, saved(groups.join(above, "rank").select("g", "path"), "merkle"))
    found = F.unhex(F.array_join(F.transform("leaves", lambda x: x["found"]), ""))
    proofs = F.pandas_udf(proved, PROOFS)("tree", "levels", "n", "path", found)
    return (
        paths.select("subroot", "leaves", proofs.alias("proofs"))
        .select("subroot", F.explode(F.arrays_zip("leaves", "proofs")).alias("x"))
        .select(
            F.col("x.leaves.key").alias(key),
            F.col("x.leaves.digest").alias("leaf"),
            "subroot",
            root.alias("root"),
            F.col("x.proofs.proof").alias("proof_sha256"),
            F.col("x.proofs.root").alias("folded_root"),
            (F.col("x.proofs.root") == root).alias("verified"),
        )
    )
