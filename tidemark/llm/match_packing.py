"""Packing of documents into sequences of a fixed capacity: large items are matched, small ones best-fit.

Lengths are whole numbers up to the capacity, so a corpus is described by how often each
length occurs: at most ``capacity`` counts, whatever the corpus holds. The packing is planned on these counts.

* Items above a third of the capacity fit at most twice into a sequence. Greedy matching, longest first,
  each with the longest partner that still fits, leaves the fewest sequences for them.
* Smaller items, longest first, go into the sequence with the least room that takes them; sequences of equal
  room are one run, so a step places as many equal items as the run takes.

Each step names a stretch of equal items (by rank among their length) and a stretch of sequences. A piece
finds its place by its length and rank, with no shuffle of texts or ids and no search over sequences.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.byte_bpe import byte_bpe
from tidemark.llm.common import ranked, saved

CAPACITY = 2_048
SLICE = 256


class Plan:
    """Steps (length, first rank, first sequence, items per sequence, offset), and sequences used."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {s: n for s, n in counts.items() if n}
        self.placed: dict[int, int] = defaultdict(int)
        self.steps: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        # room -> [(first sequence, how many)], and the rooms in order
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []
        self.match_large()
        self.fill_gaps()

    def place(self, size: int, first: int, sequences: int, each: int, offset: int) -> None:
        self.steps.append((size, self.placed[size], first, each, offset))
        self.placed[size] += sequences * each
        self.left[size] -= sequences * each

    def add_room(self, room: int, first: int, sequences: int) -> None:
        if room and sequences:
            if not self.runs[room]:
                insort(self.rooms, room)
            self.runs[room].append((first, sequences))

    def take_room(self, size: int) -> tuple[int, int, int] | None:
        """A run of sequences with the least room that takes ``size``."""
        k = bisect_left(self.rooms, size)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        first, sequences = self.runs[room].pop()
        if not self.runs[room]:
            self.rooms.pop(k)
        return room, first, sequences

    def match_large(self) -> None:
        large = sorted(s for s in self.left if 3 * s > self.capacity)
        while large:
            size = large[-1]
            k = bisect_right(large, self.capacity - size) - 1
            if k >= 0 and large[k] == size and self.left[size] == 1:
                k -= 1  # no partner in itself
            if k < 0:
                partner, sequences = None, self.left[size]
            elif large[k] == size:
                partner, sequences = size, self.left[size] // 2
            else:
                partner, sequences = large[k], min(self.left[size], self.left[large[k]])
            first, room = self.sequences, self.capacity - size
            self.sequences += sequences
            self.place(size, first, sequences, 1, 0)
            if partner is not None:
                self.place(partner, first, sequences, 1, size)
                room -= partner
            self.add_room(room, first, sequences)
            for s in {size, partner} - {None}:
                if not self.left[s]:
                    large.pop(bisect_left(large, s))

    def fill_gaps(self) -> None:
        for size in sorted((s for s, n in self.left.items() if n), reverse=True):
            while self.left[size]:
                found = self.take_room(size)
                if found is None:
                    sequences = -(-self.left[size] // (self.capacity // size))
                    found = self.capacity, self.sequences, sequences
                    self.sequences += sequences
                room, first, sequences = found
                offset, each = self.capacity - room, room // size
                full = min(sequences, self.left[size] // each)
                if full:
                    self.place(size, first, full, each, offset)
                    self.add_room(room - each * size, first, full)
                elif self.left[size]:
                    each, full = self.left[size], 1
                    self.place(size, first, 1, each, offset)
                    self.add_room(room - each * size, first, 1)
                self.add_room(room, first + full, sequences - full)

    def arrays(self) -> dict[str, np.ndarray]:
        """The steps in order of (length, rank), to be searched by one number."""
        steps = np.asarray(sorted(self.steps), np.int64).reshape(-1, 5)
        return {
            "key": (steps[:, 0] << 48) + steps[:, 1], "rank": steps[:, 1], "first": steps[:, 2],
            "each": steps[:, 3], "offset": steps[:, 4],
        }


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int | None = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: documents encoded, ended by ``end_id`` and cut.

    Only documents longer than ``capacity`` are cut: the first piece takes what the whole ones behind it leave over. ``ids`` are
    little-endian unsigned 32-bit integers. A NULL text counts as empty: its ids are the end alone (without an end id it has no
    piece). Texts of any length are encoded whole. Repeated rows give their pieces each time, a NULL ``doc_id`` stays
    NULL, other columns are ignored, an empty table gives no pieces.
    """

    end = np.asarray([] if end_id is None else [end_id], "<u4").tobytes()
    whole = capacity * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            # A few texts at a time: their ids are handed on before the next ones are made.
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                source, piece, start, ids = [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    all_ids = bpe.encode(text) + end
                    low, k = 0, 0
                    while low < len(all_ids):
                        high = low + (whole if k else len(all_ids) % whole or whole)
                        source.append(i)
                        piece.append(k)
                        start.append(low // 4)
                        ids.append(all_ids[low:high])
                        low, k = high, k + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return texts.mapInArrow(cut, schema)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; sequences have no gaps and at most ``capacity``.

    ``items`` have a whole number ``length`` from 1 to ``capacity``; other lengths, and NULL, fail the
    job. All other columns are carried along, except earlier ones named ``sequence_id`` and ``offset``. Repeated rows
    are items each. Which of several items of one length goes where is arbitrary. No items, no rows.
    The driver holds one count per length, at most ``capacity``, and the steps made from them.
    """
    spark = items.sparkSession
    items = saved(items.drop("sequence_id", "offset"), "items")
    n = items.groupBy("length").count().limit(capacity + 1).collect()
    counts = {r["length"]: r["count"] for r in n}
    if len(n) > capacity or any(s is None or not 1 <= s <= capacity for s in counts):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    steps = spark.sparkContext.broadcast(Plan(counts, capacity).arrays())

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p, size, rank = steps.value, length.to_numpy("int64"), rank.to_numpy("int64")
        k = np.searchsorted(p["key"], (size << 48) + rank, "right") - 1
        nth = rank - p["rank"][k]
        return pd.DataFrame(
            {"sequence_id": p["first"][k] + nth // p["each"][k],
             "offset": p["offset"][k] + nth % p["each"][k] * size}
        )

    # Names of the caller's columns are set aside: he may have a rank of his own.
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(items.columns)]
    at = f"c{items.columns.index('length')}"
    placed = ranked(items.select(*kept), [at], []).withColumn("place", place(at, "rank"))
    return placed.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(items.columns)], "place.sequence_id", "place.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, spans)``: the training rows themselves, of packed pieces with ``ids``.

    ``spans`` lists (doc_id, piece, offset, length) in order, for attention masks. A group has at
    most as many ids as a sequence.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform(
            "parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])
        ).alias("spans"),
    )
