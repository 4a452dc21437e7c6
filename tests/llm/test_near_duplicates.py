"""The n-gram join against all pairs of a small table."""

import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from tidemark.llm import multi_prefix_join, shingles as shingles_module
from tidemark.llm.common import components, table
from tidemark.llm.multi_prefix_join import near_duplicates


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute(rows, percent=85):
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    holders = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        (i, x), (j, y) = sets[a], sets[b]
        if 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((find(i), find(j)))
            root[hi] = lo
    return sorted(
        ((i, len(shingles(t)), None if i is None else find(i)) for i, t in rows), key=repr
    )


def test_documents(spark, sf_dir, rows):
    docs = table(spark, sf_dir, "documents")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows(near_duplicates(docs)) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies(spark, rows, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(1, 90))]
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            copy = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    data = [(i * 7, " ".join(t)) for i, t in enumerate(texts)]
    data += [(5, None), (6, ""), (8, " \t\n"), (9, "One two"), (10, "one  TWO"), (None, "one two")]
    data += [data[0], data[3], (data[0][0], "an other text of the same id altogether here")]
    data += [(11, "É ü x y"), (12, "é ü x y"), (13, "a b c d e"), (14, "x" * 100_000)]
    rng.shuffle(data)
    df = spark.createDataFrame([(*d, "s") for d in data], "doc_id long, text string, node string")
    assert rows(near_duplicates(df)) == brute(data)


def test_one_large_group(spark, rows):
    base = [f"t{i}" for i in range(200)]
    data = []
    for i in range(300):
        copy = list(base)
        copy[i % 200] = f"x{i}"
        data.append((i, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 300


def test_copies_below_the_threshold(spark, rows, monkeypatch):
    """Copies that share most of a text, few of which are linked: they don't meet in all pairs."""
    rng = random.Random(3)
    base = [f"t{i}" for i in range(150)]
    data = []
    for i in range(240):
        copy = list(base)
        for k in rng.sample(range(4, 146), 2):
            copy[k] = f"x{i}y{k}"
        data.append((i, " ".join(copy)))
    data += [(1000 + i, t + f" z{i} z z{i}" * (i % 3)) for i, t in data[:12]]
    asked = []
    inner = multi_prefix_join._links

    def counted(pairs, *more):
        asked.append(pairs.count())
        return inner(pairs, *more)

    monkeypatch.setattr(multi_prefix_join, "_links", counted)
    got = rows(near_duplicates(spark.createDataFrame(data, "doc_id long, text string")))
    assert got == brute(data)
    assert len({r[2] for r in got}) > 50
    assert sum(asked) < 10 * len(data)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_chains(spark, rows):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (105, 101), (7, 7), (None, 3)]
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 105: 100}


def peak_mb(run):
    shingles_module._powers.update({k: v[:1].copy() for k, v in shingles_module._powers.items()})
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_memory_of_a_worker():
    """It depends on the block, not on how many texts a batch brings."""
    text = " ".join(f"w{i}" for i in range(400))
    texts = [f"{k} {text}" for k in range(2_000)]
    assert peak_mb(lambda: sum(len(s) for s in shingles_module.shingle_sets(texts, 4))) < 24

    batch = pa.RecordBatch.from_pydict({"text": pa.array([t[::-1] for t in texts])})
    given = iter(multi_prefix_join.texts_of(batch))
    assert next(given) == texts[0][::-1] and peak_mb(lambda: sum(len(t) for t in given)) < 1


def test_blocks_do_not_change_sets(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") * rng.randint(1, 9) for _ in range(rng.randint(0, 60))) for _ in range(50)]
    texts += [None, "", "x" * 5_000]
    want = [s.tolist() for s in shingles_module.shingle_sets(texts, 4)]
    for size in (1, 100, 1 << 20):
        monkeypatch.setattr(shingles_module, "BLOCK_BYTES", size)
        assert [s.tolist() for s in shingles_module.shingle_sets(texts, 4)] == want
