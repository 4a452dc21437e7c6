"""Benchmark passages in documents: SimHash over item-sized windows, Hamming blocks, exact check.

An item of L words is compared with the windows of L consecutive words of each document (shorter
documents are one window). Texts are bags of five-word shingles, weighted by how often they
occur; two bags are alike when the weight they share is at least ``similarity`` of the weight of
their union. A window that shares no shingle with an item has similarity 0, so windows are taken
only where a shingle of an item stands, which loses nothing.

Each window gets a 64-bit SimHash. The items of its length are indexed by ``BLOCKS`` blocks of
bits: fingerprints within ``RADIUS`` bits of each other differ by at most ``RADIUS // BLOCKS`` bits in
at least one block, so a table of the block values that near to an item's finds every such pair.
What it finds and is within the radius is verified exactly. At a similarity of 0.8 the expected distance is
below 10 bits with a standard deviation below 3; the radius of 26 is more than 5 of them away.

Items are broadcast in slices of at most ``items_per_pass``, one pass over the documents each.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import BLOCK_BYTES, combined, word_hashes

WORDS = 5
RADIUS = 26
BLOCKS = 5
WIDTH = 13  # bits of a block; the last one has the 12 that are left
SEEN_BITS = 22

# Case and ASCII punctuation don't hide a passage.
PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))

FOUND = "similarity double, first_word int, n_words int"


def plain(text: str | None) -> bytes:
    return b"" if text is None else text.lower().encode("utf-8", "surrogatepass").translate(PLAIN)


def fingerprints(shingles: np.ndarray, width: int) -> np.ndarray:
    """SimHash of every run of ``width`` shingles: the sign of the sum of their bits' signs."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    packed = np.packbits(total[width:] - total[:-width] > 0, axis=1)
    return np.ascontiguousarray(packed).view(np.uint64).ravel()


def block_values(f: np.ndarray) -> np.ndarray:
    """(BLOCKS, n) values of the blocks of fingerprints."""
    shifts = (np.arange(BLOCKS, dtype=np.uint64) * np.uint64(WIDTH))[:, None]
    return ((f[None, :] >> shifts) & np.uint64(2**WIDTH - 1)).astype(np.int64)


class Items:
    """An index of benchmark items for one worker."""

    def __init__(self, rows: list[tuple]):
        self.ids, self.bags, self.classes = [], [], {}
        anchors: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in rows:
            h, _, _ = word_hashes(plain(text))
            if not len(h):
                continue
            k = min(WORDS, len(h))
            shingles = combined(h, k)
            at = len(self.ids)
            self.ids.append((item_id, len(h)))
            self.bags.append(np.unique(shingles, return_counts=True))
            anchors.setdefault(k, []).append((np.unique(shingles), at))
            self.classes.setdefault(len(h), []).append((at, fingerprints(shingles, len(shingles))[0]))
        # By shingle length: the sorted shingles with their items, and bits to pass most by.
        self.anchors = {}
        for k, parts in anchors.items():
            keys = np.concatenate([p[0] for p in parts])
            items = np.repeat([p[1] for p in parts], [len(p[0]) for p in parts])
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << SEEN_BITS, bool)
            seen[(keys & np.uint64((1 << SEEN_BITS) - 1)).astype(np.int64)] = True
            self.anchors[k] = keys[order], items[order], seen
        every = np.arange(2**WIDTH, dtype=np.uint64)
        for n, members in self.classes.items():
            f = np.asarray([m[1] for m in members], np.uint64)
            near = np.zeros((BLOCKS, 2**WIDTH), bool)
            for b, values in enumerate(block_values(f)):
                for v in np.unique(values):
                    near[b] |= np.bitwise_count(every ^ np.uint64(v)) <= RADIUS // BLOCKS
            self.classes[n] = np.asarray([m[0] for m in members]), f, near

    def hits(self, h: np.ndarray, ends: np.ndarray, similarity: float) -> Iterator[tuple]:
        """(text, item, similarity, first word) of the best window for each pair that is alike.

        ``h`` holds the words of several texts; text t ends before word ``ends[t]``.
        """
        asked: dict[tuple[int, int], list[int]] = {}
        for k, (keys, items, seen) in self.anchors.items():
            if len(h) < k:
                continue
            every = combined(h, k)
            at = np.flatnonzero(seen[(every & np.uint64((1 << SEEN_BITS) - 1)).astype(np.int64)])
            lo = np.searchsorted(keys, every[at], "left")
            hi = np.searchsorted(keys, every[at], "right")
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                t = int(np.searchsorted(ends, p, "right"))
                if p + k <= ends[t]:
                    for item in items[a:b].tolist():
                        asked.setdefault((t, item), []).append(p)
        checked: set[tuple[int, int]] = set()
        for (t, item), places in sorted(asked.items()):
            n = self.ids[item][1]
            if (t, n) in checked:
                continue
            checked.add((t, n))
            members, prints, near = self.classes[n]
            every_place = sorted({p for m in members.tolist() for p in asked.get((t, m), ())})
            begin, end = (int(ends[t - 1]) if t else 0), int(ends[t])
            yield from self._windows(h, t, n, begin, end, every_place, members, prints, near, similarity)

    def _windows(self, h, t, n, begin, end, places, members, prints, near, similarity):
        k = min(WORDS, n)
        last = max(begin, end - n)
        width = min(n, end - begin) - k + 1
        if width < 1:
            return
        starts = np.zeros(last - begin + 1, bool)
        for p in places:
            starts[max(0, p - n + k - begin) : min(p, last) - begin + 1] = True
        best: dict[int, tuple[float, int]] = {}
        edge = np.flatnonzero(np.diff(np.concatenate([[0], starts.view(np.int8), [0]])))
        for a, b in edge.reshape(-1, 2).tolist():
            shingles = combined(h[begin + a : begin + b - 1 + width + k - 1], k)
            f = fingerprints(shingles, width)
            values = block_values(f)
            passed = np.zeros(len(f), bool)
            for block in range(BLOCKS):
                passed |= near[block][values[block]]
            for w in np.flatnonzero(passed).tolist():
                close = np.flatnonzero(np.bitwise_count(prints ^ f[w]) <= RADIUS)
                for m in members[close].tolist():
                    s = shared_weight(shingles[w : w + width], self.bags[m])
                    if s >= similarity and s > best.get(m, (0.0,))[0]:
                        best[m] = s, a + w
        for m, (s, first) in best.items():
            yield t, m, s, first


def shared_weight(window: np.ndarray, bag: tuple[np.ndarray, np.ndarray]) -> float:
    """Weight shared by two bags of shingles over the weight of their union."""
    keys, counts = np.unique(window, return_counts=True)
    common, i, j = np.intersect1d(keys, bag[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(counts[i], bag[1][j]).sum())
    return both / (int(counts.sum()) + int(bag[1].sum()) - both)


def found_in(index: Items, texts: list[bytes], similarity: float) -> list[tuple]:
    data = b"\n".join(texts)
    h, start, _ = word_hashes(data)
    ends = np.searchsorted(start, np.cumsum([len(x) + 1 for x in texts]))
    return list(index.hits(h, ends, similarity))


def grouped(texts) -> Iterator[tuple[int, list[bytes]]]:
    """Plain texts in groups of about a block, with the place of the first."""
    first, group, size = 0, [], 0
    for text in texts:
        group.append(plain(text))
        size += len(group[-1])
        if size >= BLOCK_BYTES:
            yield first, group
            first, group, size = first + len(group), [], 0
    if group:
        yield first, group


def finder(shared, similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Items(shared.value)
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            rows = [
                (ids.iloc[first + t], *index.ids[m], s, at)
                for first, group in grouped(batch["text"])
                for t, m, s, at in found_in(index, group, similarity)
            ]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array([r[0] for r in rows], "Int64"),
                    "item_id": pd.array([r[1] for r in rows], "Int64"),
                    "similarity": [r[3] for r in rows],
                    "first_word": [r[4] for r in rows],
                    "n_words": [r[2] for r in rows],
                }
            )

    return run


def slices(benchmark: DataFrame, items_per_pass: int) -> Iterator:
    """Broadcasts of about ``items_per_pass`` items each, whatever their number."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null").distinct()
    passes = max(1, -(-items.count() // items_per_pass))
    for i in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(sorted(((r[0], r[1]) for r in part), key=repr))


def leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, items_per_pass: int = 20_000
) -> DataFrame:
    """``(doc_id, item_id, similarity, first_word, n_words)`` for each document row and item that
    is in it, with the best window (the first of equals) counted in words from 0.

    NULL, empty and wordless texts on either side are in nothing. Repeated document rows give
    repeated results, repeated items one; NULL ids stay NULL; other columns are ignored. An empty
    table on either side gives an empty result. Items of fewer than five words are one shingle.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for shared in slices(benchmark, items_per_pass):
        found = docs.mapInPandas(finder(shared, similarity), f"doc_id bigint, item_id bigint, {FOUND}")
        out = found if out is None else out.unionByName(found)
    return out


def holds(shared, similarity: float):
    """Column of texts -> does the text hold an item?"""

    @F.pandas_udf("boolean")
    def held(texts: pd.Series) -> pd.Series:
        index = worker_index(shared)
        out = np.zeros(len(texts), bool)
        for first, group in grouped(texts):
            out[[first + hit[0] for hit in found_in(index, group, similarity)]] = True
        return pd.Series(out)

    return held


@lru_cache(maxsize=1)
def worker_index(shared) -> Items:
    return Items(shared.value)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, items_per_pass: int = 20_000
) -> DataFrame:
    """``docs``, all columns, without the rows that hold an item of ``benchmark``.

    Rows are judged by their text where they stand, so repeated and NULL ids need no care; a
    NULL text holds nothing.
    """
    for shared in slices(benchmark, items_per_pass):
        docs = docs.where(~holds(shared, similarity)(F.col("text").cast("string")))
    return docs
