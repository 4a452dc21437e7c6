"""Packing: every piece once, no gaps, few sequences; ids as the library gives them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.byte_bpe import ByteBpe
from tidemark.llm.common import table
from tidemark.llm.match_packing import Plan, pack, pieces, sequences
from tidemark.llm.queries import op11_match_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    None, "", " ", "a", "x" * 9_000, "it's 12 o'clock -- naïve 中文 \U0001f600  \n\n end ", "a<|endoftext|>b",
    "word " * 5_000, "word " * 5_000, "\x00\x1c\x85   x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def filled(plan, counts):
    """All sequences of a plan, as lists of (offset, size); every item once."""
    got, seen = {}, {}
    steps = sorted(plan.steps)
    for k, (size, rank, first, each, offset) in enumerate(steps):
        follows = k + 1 < len(steps) and steps[k + 1][0] == size
        end = steps[k + 1][1] if follows else counts[size]
        assert rank == seen.get(size, 0)
        seen[size] = end
        for i in range(end - rank):
            got.setdefault(first + i // each, []).append((offset + i % each * size, size))
    assert seen == {s: n for s, n in counts.items() if n}
    for items in got.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= plan.capacity
    assert sorted(got) == list(range(plan.sequences))
    return got


def best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plans_against_item_by_item_best_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 30, 100])
    sizes = [r.randint(1, r.choice([capacity, capacity // 2, max(1, capacity // 4)])) for _ in range(r.choice([0, 1, 40, 400]))]
    counts = {s: sizes.count(s) for s in set(sizes)}
    plan = Plan(counts, capacity)
    filled(plan, counts)
    assert plan.sequences <= best_fit(sizes, capacity)


def test_large_items_need_the_fewest_sequences():
    """Against every perfect or partial matching, found by trying them all."""

    def fewest(sizes, capacity):
        if not sizes:
            return 0
        head, rest = sizes[0], sizes[1:]
        with_one = [1 + fewest(rest[:i] + rest[i + 1 :], capacity) for i, x in enumerate(rest) if head + x <= capacity]
        return min([1 + fewest(rest, capacity), *with_one])

    r = random.Random(1)
    for _ in range(60):
        sizes = [r.randint(11, 30) for _ in range(r.randint(1, 8))]
        plan = Plan({s: sizes.count(s) for s in set(sizes)}, 30)
        assert plan.sequences == fewest(sizes, 30)


def test_awkward_documents(spark, library):
    rows = [(i, t, 7, "x") for i, t in enumerate(AWKWARD)] + [(None, "no id", 7, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string")
    got = pieces(docs, PATH).collect()
    for i, t in [*enumerate(AWKWARD), (None, "no id")]:
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        want = ids_of(library, t)
        assert b"".join(bytes(r["ids"]) for r in own) == want.tobytes()
        assert [r["length"] for r in own[1:]] == [2_048] * (len(own) - 1)
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]


def test_no_end_and_no_rows(spark):
    docs = spark.createDataFrame([(1, ""), (2, "a")], "doc_id int, text string")
    assert [r["doc_id"] for r in pieces(docs, PATH, 4, None).collect()] == [2]
    empty = pack(pieces(docs.limit(0), PATH))
    assert empty.columns[-2:] == ["sequence_id", "offset"] and not empty.collect()


def test_lengths_out_of_range_fail(spark):
    for bad in (0, 11, None):
        with pytest.raises(ValueError, match="between 1 and 10"):
            pack(spark.createDataFrame([(bad,)], "length int"), 10)


def test_callers_columns_are_carried(spark):
    items = spark.createDataFrame([(3, "a", 1), (4, "b", 2), (8, "c", 3)] * 5, "length int, rank string, offset int")
    got = pack(items, 10).collect()
    assert sorted((r["length"], r["rank"]) for r in got) == sorted([(3, "a"), (4, "b"), (8, "c")] * 5)
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 15


def test_query_and_sequences(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    want = {r[0]: ids_of(library, r[1]) for r in docs.select("doc_id", "text").collect()}
    got = op11_match_packing(spark, sf_dir).collect()
    seen = dict.fromkeys(want, 0)
    for r in got:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]] += r["length"]
    assert seen == {k: len(v) for k, v in want.items()}
    total, used = sum(seen.values()), len({r["sequence_id"] for r in got})
    assert used <= -(-total // 2_048) + 2
    packed = pack(pieces(docs, PATH))
    for r in sequences(packed).collect():
        assert len(r["ids"]) <= 8_192 and sum(s["length"] for s in r["spans"]) * 4 == len(r["ids"])
        for s in r["spans"]:
            part = bytes(r["ids"])[s["offset"] * 4 : (s["offset"] + s["length"]) * 4]
            assert part in want[s["doc_id"]].tobytes()


def test_fast_encoding_is_the_librarys_for_every_letter(library):
    bpe = ByteBpe(PATH)
    assert bpe.fast is not None
    letters = [chr(c) for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c} 1{c}2 .{c}. {c}{c}  x{c}\n{c} '{c}s" for c in letters]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert bpe.encode(text) == np.asarray(want.ids, "<u4").tobytes()


def test_hot_length(spark):
    """Half of all items have one length."""
    items = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 9 + 1).alias("length"))
    got = pack(items, 10).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k"))
    most, items_, used = got.agg(F.max("n"), F.sum("k"), F.count("*")).first()
    total = items.agg(F.sum("length")).first()[0]
    assert most <= 10 and items_ == 4_000 and used <= total / 10 + 60
