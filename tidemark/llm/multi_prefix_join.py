"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Shingles are put into one global order, rare ones first by a frequency sketch of the whole
corpus, then by hash. Two sets with Jaccard similarity s share at least ceil(s * size) shingles of
either; so with prefixes of ``size - ceil(s * size) + m`` shingles they share at least ``m``
inside the prefixes. Each document takes the ``m`` (1 to ``MOST``) with the least estimated cost:
a longer prefix makes more entries but asks for more shared ones before anything is verified. A
pair must share as many as the smaller ``m`` of the two.

Only connected components are asked for, so pairs within a group aren't all visited:
1. Texts with equal sets are one node.
2. Each token has a pivot, the node whose prefix tokens are the most common. Each node is verified against
   the pivot of most of its prefix entries. Near copies of one text thereby become one component, in time
   linear in their number.
3. Nodes of one pivot are compared by what sets them apart from it: with differences ``D`` from the pivot,
   two sets differ in ``|D1| + |D2| - 2 |D1 and D2|`` shingles. If nothing shared is needed both are linked
   with the pivot, else they meet at a rare shared difference. So copies that lie just below the threshold
   of each other don't meet by all that the copies have in common.
4. Of all these pairs, and of those that share enough entries of tokens whose pivot isn't both nodes' own,
   which lie in different components, first each node is verified against the one it shares most with, then
   the pairs that still lie apart. No link is lost: a pair that isn't visited is connected already.
Verification counts exactly, over whole sets made again from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, saved
from tidemark.llm.shingles import mixed, shingle_sets

CELLS = 1 << 17  # of the frequency sketch: bounds what is broadcast
MOST = 4
VERIFY = 8.0  # cost of a verification in entries read
NEAR = 4  # a set is described by its differences from a pivot if they are at most 1 / NEAR of both sizes
ENTRIES_PER_BATCH = 100_000
PAIR = pa.schema({"a": pa.int64(), "b": pa.int64()})
COMPARED = pa.schema(
    {"a": pa.int64(), "b": pa.int64(), "n": pa.int64(), "linked": pa.bool_(), "apart": pa.list_(pa.int64())}
)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """A column's texts one at a time: a worker holds the batch and one block of texts, not a second copy of all."""
    return (t.as_py() for t in batch.column(name))


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    with np.errstate(over="ignore"):
        h = mixed(shingles + np.uint64(0x51ED270B))
        return int(mixed(np.asarray([h.sum(dtype=np.uint64) * np.uint64(3) + np.bitwise_xor.reduce(h) + np.uint64(len(h))]))[0].astype(np.int64))


def nodes_and_sketch(words: int):
    """(doc_id, text) -> rows (doc_id, node, n) and, at a task's end, its frequency counts as
    rows (cell, hits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "node", "n", "cell", "hits"]
        hits = np.zeros(CELLS, np.int64)
        for batch in batches:
            nodes, sizes = [], []
            for s in shingle_sets(texts_of(batch), words):
                np.add.at(hits, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
                nodes.append(node_of(s) if len(s) else None)
                sizes.append(len(s))
            none = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *none], names
            )
        cells = np.flatnonzero(hits)
        none = [pa.nulls(len(cells), pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([*none, pa.array(cells, pa.int32()), pa.array(hits[cells])], names)

    return run


def required(n: int, percent: int) -> int:
    """The least number of shingles a set of ``n`` shares with any set it is linked with."""
    return -(-n * percent // 100)


def prefix(s: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set and its number of matches, by least estimated cost."""
    n = len(s)
    need = required(n, percent)
    most = min(MOST, need)
    longest = n - need + most
    seen = sketch[(s & np.uint64(CELLS - 1)).astype(np.int64)]
    # Rare first: by the power of two of the estimate, then by hash.
    order = np.lexsort((s, np.frexp(seen.astype(np.float64))[1]))[:longest]
    cost = np.cumsum(seen[order], dtype=np.float64)
    matches = np.arange(1, most + 1)
    m = int(np.argmin(cost[n - need + matches - 1] * (1 + VERIFY / matches**2))) + 1
    return s[order[: n - need + m]], m


def entries(shared, words: int, percent: int):
    """text -> prefix entries (token, node, nm), once per node of a task's recent texts; nm holds
    the size of the set, the token's place in its order and its number of matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, recent = shared.value, set()
        parts: list[tuple] = []
        held = 0

        def frame():
            sizes = [len(p[0]) for p in parts]
            return pa.RecordBatch.from_pydict(
                {
                    "token": np.concatenate([p[0] for p in parts]).astype(np.int64),
                    "node": np.repeat([p[1] for p in parts], sizes),
                    "nm": np.concatenate(
                        [(p[2] << 31) + (np.arange(len(p[0])) << 3) + p[3] for p in parts]
                    ),
                }
            )

        for batch in batches:
            for s in shingle_sets(texts_of(batch), words):
                if not len(s):
                    continue
                node = node_of(s)
                if node in recent:
                    continue
                if len(recent) >= 200_000:
                    recent.clear()
                recent.add(node)
                tokens, m = prefix(s, sketch, percent)
                parts.append((tokens, node, len(s), m))
                held += len(tokens)
                if held >= ENTRIES_PER_BATCH:
                    yield frame()
                    parts, held = [], 0
        if parts:
            yield frame()

    return run


def set_pairs(batch: pa.RecordBatch, last: list, words: int) -> Iterator[tuple]:
    """(a, b, set of a, set of b) of the rows (a, text_a, b, text_b) whose texts are their nodes' own.

    ``last`` keeps what is known of the last ``b`` from batch to batch.
    """
    left = shingle_sets(texts_of(batch, "text_a"), words)
    ends = batch.column("a").to_pylist(), batch.column("b").to_pylist()
    for a, b, text_b, s in zip(*ends, texts_of(batch, "text_b"), left, strict=True):
        if not last or last[0] != b or last[2] != text_b:
            t = next(shingle_sets([text_b], words))
            last[:] = b, t, text_b, node_of(t) == b
        if last[3] and node_of(s) == a:
            yield a, b, s, last[1]


def similar(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(s) + len(t) - both)


def verified(words: int, percent: int):
    """(a, text_a, b, text_b) -> the pairs (a, b) whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = []
        for batch in batches:
            found = [(a, b) for a, b, s, t in set_pairs(batch, last, words) if similar(s, t, percent)]
            yield pa.RecordBatch.from_pylist([dict(zip("ab", x, strict=True)) for x in found], PAIR)

    return run


def differences(s: np.ndarray, pivot: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """What ``s`` has more or less than ``pivot``, by what is rare among the pivot's copies; the order
    depends on the pivot alone."""
    apart = np.setxor1d(s, pivot, assume_unique=True)
    seen = sketch[(apart & np.uint64(CELLS - 1)).astype(np.int64)]
    usual = int(np.median(sketch[(pivot & np.uint64(CELLS - 1)).astype(np.int64)]))
    lacking = np.isin(apart, pivot, assume_unique=True)
    return apart[np.lexsort((apart, np.where(lacking, np.maximum(usual - seen, 0), seen)))]


def compared(shared, words: int, percent: int):
    """(a, text_a, b, text_b) -> rows (a, b, n, linked, apart): the size of a's set, and its differences from
    b's unless they are many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = []
        for batch in batches:
            found = []
            for a, b, s, t in set_pairs(batch, last, words):
                apart = differences(s, t, shared.value)
                near = NEAR * len(apart) <= len(s) + len(t)
                found.append((a, b, len(s), similar(s, t, percent), apart.astype(np.int64) if near else None))
            if found:
                columns = zip(zip(*found, strict=True), COMPARED, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, kind.type) for x, kind in columns], schema=COMPARED)

    return run


def _texts(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, text)`` of the nodes in ``pairs``, fetched once."""
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    heads = asked.join(nodes, "node").select("node", "head")
    return saved(
        docs.select(F.col("doc_id").alias("head"), "text").join(heads, "head")
        # Repeated rows once; of several texts of one id the verification keeps the node's own.
        .groupBy("node", F.xxhash64("text").alias("hash")).agg(F.first("text").alias("text")),
        "candidate-texts",
    )


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "text_a", "b", "text_b")


def _links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of nodes that are linked."""
    rows = _with_texts(pairs, texts)
    return saved(rows.mapInArrow(verified(words, percent), "a bigint, b bigint"), "links")


def _by_differences(members: DataFrame, percent: int) -> DataFrame:
    """``(a, b, shared)``: pairs of ``members(node, pivot, n, c, apart)`` of one pivot and different components
    ``c`` that may be linked.

    Sets of ``n1`` and ``n2`` shingles are linked if and only if they differ in at most
    ``(100 - percent) (n1 + n2) / (100 + percent)``. So differences of d1 and d2 shingles must share ``needed``
    of them, up to ``MOST`` of which stand so early that there is room for the others behind them. Pairs that need none are both
    linked with the pivot: the excess of one of them is at most 0, and the sizes differ by no more than that.
    """
    excess = F.size("apart") * (100 + percent) - F.col("n") * (100 - percent)

    def needed(a: str, b: str) -> Column:
        return F.greatest(F.ceil((F.col(a) + F.col(b)) / (2 * (100 + percent))), F.lit(1))

    known = members.withColumn("excess", excess)
    groups = known.groupBy("pivot").agg(
        F.min("excess").alias("least_excess"), F.min("c").alias("lo"), F.max("c").alias("hi")
    )
    placed = saved(
        known.join(groups.where("lo <> hi").drop("lo", "hi"), "pivot")
        .select(
            "pivot", "node", "c", "excess", F.size("apart").alias("d"), "least_excess",
            F.posexplode("apart").alias("place", "token"),
        )
        .where(F.col("place") < F.col("d") - needed("excess", "least_excess") + MOST)
        .drop("least_excess"),
        "differences",
    )

    def side(name: str, i: int) -> DataFrame:
        return placed.select(
            "pivot", "token", F.col("node").alias(name), *[F.col(x).alias(f"{x}{i}") for x in ("c", "excess", "d", "place")]
        )

    need = needed("excess1", "excess2")
    matches = F.least(need, F.lit(MOST))
    rest = need - matches
    return (
        side("a", 1)
        .join(side("b", 2), ["pivot", "token"])
        .where((F.col("c1") < F.col("c2")) & (F.col("place1") < F.col("d1") - rest) & (F.col("place2") < F.col("d2") - rest))
        .groupBy("a", "b", matches.alias("matches"))
        .agg(F.count("token").alias("shared"))
        .where("shared >= matches")
        .select("a", "b", "shared")
    )


def _standing_for(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """``pairs`` with the components ``ca`` and ``cb`` of their ends."""
    for end in ("a", "b"):
        own = joined.select(F.col("id").alias(end), F.col("component_id").alias(f"c{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return pairs


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs(doc_id, text)``.

    Two documents are linked when ``100 * |A and B| >= percent * |A or B|`` over their distinct
    ``words``-word shingles; ``component_id`` is the smallest id reachable. Texts without words
    (NULL, empty) have 0 shingles and are linked with nothing. Repeated rows stay repeated and
    share a component; rows of one id with different texts are one document of several sets.
    A NULL ``doc_id`` is linked with nothing and has a NULL component. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = saved(
        docs.mapInArrow(
            nodes_and_sketch(words), "doc_id bigint, node bigint, n bigint, cell int, hits bigint"
        ),
        "nodes",
    )
    of_docs = first.where("cell is null").select("doc_id", "node", "n")
    nodes = of_docs.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("head")
    )
    sketch = np.zeros(CELLS, np.int64)
    # At most CELLS rows.
    for cell, hits in first.where("cell is not null").groupBy("cell").agg(F.sum("hits")).collect():
        sketch[cell] = hits
    shared = spark.sparkContext.broadcast(sketch)

    found = saved(
        docs.where("doc_id is not null").mapInArrow(
            entries(shared, words, percent), "token bigint, node bigint, nm bigint"
        ),
        "entries",
    )
    # Keep entries whose token stands in another node too: its least and largest node differ.
    # Counted before the shuffle, and joined back, so that a hot token can be split.
    ends = found.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("largest"))
    common = found.join(ends.where("least <> largest").select("token"), "token").distinct()
    common = saved(
        common.select(
            "token",
            "node",
            F.shiftright("nm", 31).alias("n"),
            F.shiftright("nm", 3).bitwiseAND(2**28 - 1).alias("place"),
            F.col("nm").bitwiseAND(7).alias("m"),
        ),
        "common-entries",
    )

    def within() -> Column:
        """Sizes that can be linked, and both entries inside the prefixes this pair needs.

        Sets of n1 and n2 shingles that are linked share at least
        ``percent (n1 + n2) / (100 + percent)``, which is more than either asks for alone.
        """
        shared = F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent)) - F.least("m1", "m2")
        return (
            (F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent)
            & (F.col("place1") < F.col("n1") - shared)
            & (F.col("place2") < F.col("n2") - shared)
        )

    def side(entries: DataFrame, name: str, i: int, *more: str) -> DataFrame:
        return entries.select(
            "token",
            F.col("node").alias(name),
            F.col("n").alias(f"n{i}"),
            F.col("place").alias(f"place{i}"),
            F.col("m").alias(f"m{i}"),
            *more,
        )

    often = common.groupBy("token").agg(F.count("node").alias("times"))
    score = common.join(often, "token").groupBy("node").agg(F.sum("times").alias("score"))
    pivots = saved(
        common.join(score, "node")
        .groupBy("token")
        .agg(F.max_by(F.struct("node", "n", "place", "m"), F.struct("score", "node")).alias("top"))
        .select("token", "top.*"),
        "pivots",
    )
    stars = (
        side(common, "a", 1)
        .join(side(pivots, "b", 2), "token")
        .where((F.col("a") != F.col("b")) & within())
        .groupBy("a", "b")
        .agg(F.count("token").alias("shared"))
        # Fewer than a link asks for too: what just misses a link with the pivot is told by its differences.
        .groupBy("a")
        .agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    )
    stars = saved(stars, "stars")
    seen = saved(
        _with_texts(stars, _texts(stars, nodes, docs)).mapInArrow(
            compared(shared, words, percent), "a bigint, b bigint, n bigint, linked boolean, apart array<bigint>"
        ),
        "compared",
    )
    joined = saved(components(seen.where("linked").select("a", "b")), "star-components")
    of_nodes = joined.select(F.col("id").alias("node"), F.col("component_id").alias("c"))
    members = seen.where("apart is not null").select(
        F.col("a").alias("node"), F.col("b").alias("pivot"), "n", "apart"
    )
    labelled = (
        common.join(of_nodes, "node", "left")
        .join(members.select("node", "pivot"), "node", "left")
        .join(pivots.select("token", F.col("node").alias("top")), "token")
        .select(
            "token", "node", "n", "place", "m", F.coalesce("c", "node").alias("c"),
            ((F.col("node") == F.col("top")) | F.coalesce(F.col("pivot") == F.col("top"), F.lit(False))).alias("near"),
        )
    )
    mixed_tokens = labelled.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    open_entries = saved(labelled.join(mixed_tokens.select("token"), "token"), "open-entries")
    # Where the token's pivot is both nodes' own they meet by their differences from it, or have met as stars.
    lower = F.col("c1") < F.col("c2")
    by_entries = (
        side(open_entries.where("not near"), "x", 1, F.col("c").alias("c1"))
        .join(side(open_entries, "y", 2, F.col("c").alias("c2"), "near"), "token")
        .where((F.col("c1") != F.col("c2")) & (F.col("near") | lower) & within())
        .groupBy(
            F.when(lower, F.col("x")).otherwise(F.col("y")).alias("a"),
            F.when(lower, F.col("y")).otherwise(F.col("x")).alias("b"),
            F.least("m1", "m2").alias("needed"),
        )
        .agg(F.count("token").alias("shared"))
        .where("shared >= needed")
        .select("a", "b", "shared")
    )
    by_differences = _by_differences(
        members.join(of_nodes, "node", "left").withColumn("c", F.coalesce("c", "node")), percent
    )
    rest = by_entries.unionByName(by_differences).groupBy("a", "b").agg(F.max("shared").alias("shared"))
    rest = saved(rest, "rest")
    # First each node with the one it shares most with, then what still lies apart.
    texts = _texts(rest, nodes, docs)
    best = rest.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    best_links = _links(saved(best, "best"), texts, words, percent)
    near = saved(
        components(_standing_for(best_links, joined).select(F.col("ca").alias("a"), F.col("cb").alias("b"))),
        "best-components",
    ).select(F.col("id").alias("c"), F.col("component_id").alias("wider"))
    apart = _standing_for(rest.join(best, ["a", "b"], "left_anti"), joined)
    for end in ("ca", "cb"):
        apart = apart.join(near.withColumnRenamed("c", end), end, "left").withColumn(
            end, F.coalesce("wider", end)
        ).drop("wider")
    apart = saved(apart.where("ca <> cb").select("a", "b"), "apart")
    rest_links = best_links.unionByName(_links(apart, texts, words, percent))

    # Several sets of one id belong together.
    heads = of_docs.where("node is not null and doc_id is not null").select("doc_id", "node").distinct()
    several = heads.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    same = several.select("doc_id", "a").join(heads, "doc_id").where("node <> a").select("a", F.col("node").alias("b"))
    # What is left joins components, so each end stands for the component it is in.
    ends = _standing_for(rest_links.unionByName(same), joined).select(
        F.col("ca").alias("a"), F.col("cb").alias("b")
    )
    whole = saved(components(ends), "components").select(F.col("id").alias("c1"), F.col("component_id").alias("c2"))
    component = (
        nodes.join(joined.select(F.col("id").alias("node"), F.col("component_id").alias("c")), "node", "left")
        .withColumn("c1", F.coalesce("c", "node"))
        .drop("c")
        .join(whole, "c1", "left")
        .select("node", "head", F.coalesce("c2", "c1").alias("c"))
    )
    component = component.join(component.groupBy("c").agg(F.min("head").alias("component_id")), "c")
    return of_docs.join(component.select("node", "component_id"), "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
