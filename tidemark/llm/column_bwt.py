"""Repeated byte strings, found by column-wise construction of a collection's Burrows-Wheeler order.

Bytes are removed that lie in a string of ``LENGTH`` bytes which also starts elsewhere. Building one
order of all suffixes takes a round per symbol of the longest document over everything inserted so far; so
the collection is first cut, without loss, into pieces that can be ordered apart:

1. Every window of ``LENGTH`` bytes names its anchor, the leftmost of its ``GRAM``-byte strings with
   the least hash. Equal windows have equal anchors at the same place. The windows of one anchor
   are consecutive and form a piece of at most ``COLUMNS`` bytes, aligned by the anchor.
2. Anchors that occur once belong to unrepeated windows; their pieces are dropped.
3. Anchors of more than ``COLLECTION`` pieces are split by the columns that windows of a range of starts
   have in common, in halves of the range, down to single windows; what stands alone leaves (``split``).
4. The pieces of a partition, with all pieces of a group together, are a collection of short documents. Starting
   behind their last column, each round inserts one symbol per piece: the order of the suffixes
   at a column is the stable sort, by the symbols there, of the order at the next column (the
   step by which the transform grows), and the lengths of common prefixes follow by range minima
   between equal symbols. Where two neighbours share ``LENGTH`` bytes, both windows are repeated.
   Columns of large collections are kept in sequential temporary files, of which a round reads one column.

Equal pieces are told by a 128-bit hash and stand for one; documents with equal bytes likewise.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.llm.shingles import BASE, INVERSE, mixed, powers

LENGTH = 400
GRAM = 100
SPREAD = LENGTH - GRAM + 1  # anchors a window chooses from
COLUMNS = SPREAD - 1 + LENGTH
COLLECTION = 16_384  # pieces of a group at most; ordered together are at least as many, if there are, and under twice
SPILL = 64 << 20
CONSTANT = np.uint64(0xFFFFFFFF)
RANGES = "array<struct<lo: bigint, hi: bigint>>"


def anchors(data: bytes) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window, is a run) of the anchors of ``data``.

    Windows of one repeated byte, whose grams are all alike, have the anchor at their own start;
    consecutive ones are one range, a run, whose windows repeat each other.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    a = np.frombuffer(data, np.uint8)
    with np.errstate(over="ignore"):
        terms = (a.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        grams = mixed((total[GRAM:] - total[:-GRAM]) * powers(INVERSE, n)[: n - GRAM + 1])
    same = np.concatenate([[0], np.cumsum(a[1:] == a[:-1])])
    constant = same[GRAM - 1 :] - same[: n - GRAM + 1] == GRAM - 1
    rank = np.minimum(grams >> np.uint64(32), CONSTANT - np.uint64(1))
    rank[constant] = CONSTANT
    rank = rank << np.uint64(32) | np.arange(len(rank), dtype=np.uint64)
    # Sliding minima of SPREAD ranks: from running minima of blocks, forwards and backwards.
    blocks = np.full(-(-len(rank) // SPREAD) * SPREAD, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(rank)] = rank
    blocks = blocks.reshape(-1, SPREAD)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - LENGTH + 1
    least = np.minimum(backward[:windows], forward[SPREAD - 1 : SPREAD - 1 + windows])
    place = (least & CONSTANT).astype(np.int64)
    alone = least >> np.uint64(32) == CONSTANT
    begins = np.ones(windows, bool)
    begins[1:] = (place[1:] != place[:-1]) & ~(alone[1:] & alone[:-1])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], windows) - 1
    return grams[place[first]], place[first], first, last, alone[first] & (last > first)


def text_hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, text) -> a row for each document, and a row for each of its anchors unless the
    task has seen the same bytes lately."""
    recent: set[bytes] = set()
    for batch in batches:
        hashes, sizes, digests, found = [], [], [], []
        for text in batch["text"]:
            data = encoded(text)
            h = text_hash(data)
            hashes.append(h)
            sizes.append(len(data))
            digests.append(hashlib.sha256(data).hexdigest())
            if len(data) >= LENGTH and h not in recent:
                if len(recent) >= 100_000:
                    recent.clear()
                recent.add(h)
                grams, _, _, _, run = anchors(data)
                keys, times = np.unique(np.concatenate([grams, grams[run]]), return_counts=True)
                found.append((h, keys.astype(np.int64), times))
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"].astype("Int64"), "h": hashes, "n_bytes": pd.array(sizes, "Int64"),
             "sha": digests, "anchor": pd.array([None] * len(batch), "Int64"),
             "times": pd.array([None] * len(batch), "Int64")}
        )
        if found:
            keys = np.concatenate([f[1] for f in found])
            none = [None] * len(keys)
            yield pd.DataFrame(
                {"doc_id": pd.array(none, "Int64"), "h": np.repeat(np.asarray([f[0] for f in found], object), [len(f[1]) for f in found]),
                 "n_bytes": pd.array(none, "Int64"), "sha": none, "anchor": keys,
                 "times": np.concatenate([f[2] for f in found])}
            )


def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(h, text, kept anchors) -> the pieces' places, with their bytes once per task."""
    recent: set[bytes] = set()
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for h, text, kept in zip(batch["h"], batch["text"], batch["kept"], strict=True):
            data = encoded(text)
            keys, place, first, last, run = anchors(data)
            for i in np.flatnonzero(np.isin(keys.astype(np.int64), np.asarray(kept, np.int64))).tolist():
                s, e = int(first[i]), int(last[i])
                alone = bool(run[i])
                # Of a run one window stands for all in the order.
                piece = data[s : (s if alone else e) + LENGTH]
                name = text_hash(piece)
                new = name not in recent
                if new:
                    if len(recent) >= 200_000:
                        recent.clear()
                    recent.add(name)
                    size += len(piece)
                lead = SPREAD - 1 - (int(place[i]) - s)
                rows.append((int(keys[i].astype(np.int64)), name, piece if new else None, lead, h, s, e, alone))
                if size >= 8 << 20 or len(rows) >= 100_000:
                    yield pd.DataFrame(rows, columns=PIECE)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=PIECE)


PIECE = ["anchor", "name", "piece", "lead", "h", "first", "last", "alone"]


class Columns:
    """Pieces aligned in columns, 0 where a piece has no byte; blocks go to a file when large."""

    def __init__(self):
        self.blocks: list[np.ndarray] = []
        self.places: list[tuple[int, int]] = []
        self.file = None
        self.size = 0
        self.count = 0

    def add(self, pieces: list[bytes], leads: list[int]) -> None:
        block = np.zeros((len(pieces), COLUMNS), np.uint16)
        for row, piece, lead in zip(block, pieces, leads, strict=True):
            row[lead : lead + len(piece)] = np.frombuffer(piece, np.uint8)
            row[lead : lead + len(piece)] += 1
        block = np.ascontiguousarray(block.T)
        self.count += len(pieces)
        self.size += block.nbytes
        if self.size <= SPILL:
            self.blocks.append(block)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.places.append((self.file.tell(), len(pieces)))
        self.file.write(block.tobytes())

    def column(self, j: int) -> np.ndarray:
        parts = [b[j] for b in self.blocks]
        for at, n in self.places:
            self.file.seek(at + 2 * n * j)
            parts.append(np.frombuffer(self.file.read(2 * n), np.uint16))
        if self.places:
            self.file.seek(0, 2)
        return np.concatenate(parts)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def repeated(columns: Columns) -> np.ndarray:
    """(SPREAD, pieces): is the window that starts at a column repeated in an other piece?"""
    m = columns.count
    order = np.arange(m)
    common = np.zeros(m + 1, np.int16)  # with the piece before in the order; a spare at the end
    out = np.zeros((SPREAD, m), bool)
    for j in range(COLUMNS - 1, -1, -1):
        symbols = columns.column(j)[order]
        moved = np.argsort(symbols, kind="stable")
        order, symbols = order[moved], symbols[moved]
        equal = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] > 0))
        # Least common length between the two old places, the later one included.
        low, high = moved[equal] + 1, moved[equal + 1] + 1
        now = np.zeros(m + 1, np.int16)
        if len(equal):
            ranges = np.stack([low, high], axis=1).ravel()
            now[equal + 1] = np.minimum.reduceat(common, ranges)[::2] + 1
        common = now
        if j < SPREAD:
            at = np.flatnonzero(common[:m] >= LENGTH)
            out[j, order[at]] = True
            out[j, order[at - 1]] = True
    return out


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in edge.reshape(-1, 2)]


def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(anchor, name, piece, lead, shift) sorted by anchor and name -> ranges of repeated windows.

    ``anchor`` names the group. ``shift`` windows of the named piece lie before the given bytes.
    """
    columns, names, leads, shifts = Columns(), [], [], []
    last_anchor, last_name = None, None

    def close():
        marks = repeated(columns)
        rows = []
        for k in np.flatnonzero(marks.any(axis=0)).tolist():
            found = runs(np.ascontiguousarray(marks[leads[k] :, k]))
            rows.append((names[k], [{"lo": a + shifts[k], "hi": b + shifts[k]} for a, b in found]))
        columns.close()
        # Arrow takes no frame without rows for a binary column.
        return [pd.DataFrame(rows, columns=["name", "ranges"])] if rows else []

    for batch in batches:
        start = 0
        anchor = batch["anchor"].to_numpy()
        edges = [*(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(batch)]
        for end in edges:
            if end == start:
                continue
            if anchor[start] != last_anchor and columns.count >= COLLECTION:
                yield from close()
                columns, names, leads, shifts = Columns(), [], [], []
                last_name = None
            if anchor[start] != last_anchor:
                last_name = None
            last_anchor = anchor[start]
            part = batch.iloc[start:end]
            fresh, at = [], []
            for name, piece, lead, shift in zip(
                part["name"], part["piece"], part["lead"], part["shift"], strict=True
            ):
                if name != last_name:
                    last_name = name
                    names.append(name)
                    leads.append(lead)
                    shifts.append(shift)
                    fresh.append(piece)
                    at.append(lead)
            if fresh:
                columns.add(fresh, at)
            start = end
    if columns.count:
        yield from close()


def halved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of ``GROUP`` -> for each half of their range of window starts, if the piece has windows there,
    a row with the bytes of these windows alone.

    All windows that start in columns ``lo`` to ``hi`` hold the columns ``hi`` to ``lo + LENGTH - 1``, so
    pieces that share one of them agree there: these bytes name the new group. ``same`` names the bytes of
    all the piece's windows in the half: where it is equal, all of them are.
    """
    for batch in batches:
        rows = []
        for anchor, name, piece, lead, shift, low, high in batch[GROUP].itertuples(index=False):
            middle = (low + high) // 2
            for lo, hi in {(low, middle), (min(middle + 1, high), high)}:
                a, b = max(lo, lead), min(hi, lead + len(piece) - LENGTH)
                if a > b:
                    continue
                part = piece[a - lead : b - lead + LENGTH]
                shared = anchor.to_bytes(8, "little", signed=True) + bytes([lo // 256, lo % 256, hi // 256, hi % 256])
                group = text_hash(shared + part[hi - a : lo + LENGTH - a])
                same = text_hash(a.to_bytes(2, "little") + part)
                rows.append((int.from_bytes(group[:8], "little", signed=True), name, part, a, shift + a - lead, lo, hi, same, b - a))
        if rows:
            yield pd.DataFrame(rows, columns=[*GROUP, "same", "more"])


GROUP = ["anchor", "name", "piece", "lead", "shift", "lo", "hi"]
HALVES = (
    "anchor bigint, name binary, piece binary, lead int, shift int, lo int, hi int, same binary, more int"
)


def split(pieces: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``pieces(anchor, name, piece, lead)`` -> groups of at most ``COLLECTION`` different pieces, in the
    columns of ``GROUP``, and the ranges ``(name, ranges)`` that were found on the way, if any anchor had more.

    Pieces with a window in common are in a group together with that window, or have it in the ranges.
    Of pieces that are equal in all of a range one stays for the others. A range of one window has
    equal pieces only, so at most nine rounds are made, each over the pieces of too large groups.
    """
    pieces = pieces.select(
        "anchor", "name", "piece", "lead",
        F.lit(0).alias("shift"), F.lit(0).alias("lo"), F.lit(SPREAD - 1).alias("hi"),
    )
    done, ranges = None, None

    def parted(rows: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The rows of groups that are small enough, and the others if there are any."""
        large = saved(sizes.where(F.col("size") > COLLECTION).select("anchor"), "large-groups")
        if large.isEmpty():
            return rows, None
        return rows.join(large, "anchor", "left_anti"), rows.join(large, "anchor", "left_semi")

    # Rows, of which there are no fewer than different pieces.
    done, rest = parted(pieces, pieces.groupBy("anchor").agg(F.count("lead").alias("size")))
    while rest is not None:
        rows = saved(rest.mapInPandas(halved, HALVES), "halves")
        classes = saved(
            rows.groupBy("anchor", "same", "lo", "hi").agg(
                F.min(F.struct("name", "shift")).alias("one"),
                (F.min("name") != F.max("name")).alias("several"),
                F.first("piece").alias("piece"),
                F.first("lead").alias("lead"),
            ),
            "equal-halves",
        )
        equal = classes.where("several").select("anchor", "same", "lo", "hi")
        found = rows.join(equal, ["anchor", "same", "lo", "hi"], "left_semi").select(
            "name",
            F.array(
                F.struct(
                    F.col("shift").cast("long").alias("lo"), (F.col("shift") + F.col("more")).cast("long").alias("hi")
                )
            ).alias("ranges"),
        )
        ranges = found if ranges is None else ranges.unionByName(found)
        sizes = classes.groupBy("anchor").agg(F.count("lead").alias("size"))
        # What is alone in its group has no window in common with an other piece.
        shared = classes.join(sizes.where("size > 1").select("anchor"), "anchor", "left_semi").select(
            "anchor", "one.name", "piece", "lead", "one.shift", "lo", "hi"
        )
        small, rest = parted(shared, sizes)
        done = done.unionByName(small)
    return done, ranges


def united(h_ranges: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(h, text, windows) -> (h, spans): maximal runs of covered bytes, end exclusive, and the rest's hash."""
    for batch in h_ranges:
        rows = []
        for h, text, windows in zip(batch["h"], batch["text"], batch["windows"], strict=True):
            data = encoded(text)
            edge = np.zeros(len(data) + 1, np.int32)
            for w in windows:
                edge[w["lo"]] += 1
                edge[w["hi"] + LENGTH] -= 1
            covered = np.cumsum(edge[:-1]) > 0
            kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
            spans = runs(covered)
            rows.append(
                (h, [{"lo": a, "hi": b + 1} for a, b in spans], int(covered.sum()), hashlib.sha256(kept).hexdigest())
            )
        yield pd.DataFrame(rows, columns=["h", "spans", "n_removed", "sha"])


def repeated_strings(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, one row per row of ``docs(doc_id, text)``.

    ``spans`` are the maximal removed runs of bytes (UTF-8), end exclusive. A NULL text is empty.
    Repeated rows are other places of the same strings: all of their windows are repeated.
    NULL ids are documents like others; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = saved(
        docs.mapInPandas(
            described, "doc_id bigint, h binary, n_bytes bigint, sha string, anchor bigint, times bigint"
        ),
        "anchors",
    )
    of_docs = first.where("anchor is null").select("doc_id", "h", "n_bytes", "sha")
    places = first.where("anchor is not null").select("anchor", "h", "times")
    often = (
        places.groupBy("anchor")
        .agg(F.min("h").alias("one"), F.max("h").alias("other"), F.max("times").alias("times"))
        .where("one <> other or times > 1")
        .select("anchor")
    )
    kept = places.join(often, "anchor").select("h", "anchor").groupBy("h").agg(
        F.collect_set("anchor").alias("kept")
    )
    texts = saved(
        docs.where(F.octet_length("text") >= LENGTH)
        .mapInPandas(hashed, "h binary, text string")
        .groupBy("h")
        .agg(F.first("text").alias("text"))
        .join(kept, "h"),
        "candidate-texts",
    )
    pieces = saved(
        texts.mapInPandas(
            cut,
            "anchor bigint, name binary, piece binary, lead int, h binary, first bigint, last bigint, alone boolean",
        ),
        "pieces",
    )
    groups, equal = split(pieces.where("piece is not null"))
    ranges = saved(
        groups.select("anchor", "name", "piece", "lead", "shift")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "name")
        .mapInPandas(ordered, f"name binary, ranges {RANGES}"),
        "repeated-windows",
    )
    if equal is not None:
        # Of a split piece each range is known apart.
        ranges = ranges.unionByName(equal).groupBy("name").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    times = pieces.groupBy("name").agg(F.count("h").alias("n"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("last") - F.col("first")).alias("hi")))
    windows = (
        pieces.select("name", "h", "first", "last", "alone")
        .join(times, "name")
        .join(ranges, "name", "left")
        .withColumn(
            "ranges",
            F.when((F.col("n") > 1) | F.col("alone"), whole).otherwise(F.col("ranges")),
        )
        .where("ranges is not null")
        .select("h", F.explode("ranges").alias("r"), "first")
        .groupBy("h")
        .agg(
            F.collect_list(
                F.struct((F.col("first") + F.col("r.lo")).alias("lo"), (F.col("first") + F.col("r.hi")).alias("hi"))
            ).alias("windows")
        )
    )
    spans = saved(
        texts.select("h", "text").join(windows, "h").mapInPandas(
            united, f"h binary, spans {RANGES}, n_removed bigint, sha string"
        ),
        "spans",
    )
    copies = of_docs.groupBy("h").agg(F.count("n_bytes").alias("copies")).where("copies > 1")
    joined = of_docs.join(copies, "h", "left").join(spans.withColumnRenamed("sha", "kept_sha"), "h", "left")
    all_of_it = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    nothing = F.array().cast(RANGES)
    found = F.when(
        all_of_it, F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n_bytes").alias("hi")))
    ).otherwise(F.coalesce("spans", nothing))
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(all_of_it, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(found).cast("long").alias("n_spans"),
        F.when(all_of_it, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        found.alias("spans"),
    )


def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"h": [text_hash(encoded(t)) for t in batch["text"]], "text": batch["text"]})
