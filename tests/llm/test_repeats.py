"""Repeated byte strings against every window of every text."""

import hashlib
import random
from collections import Counter

from tidemark.llm import column_bwt
from tidemark.llm.common import table
from tidemark.llm.column_bwt import repeated_strings

L = 400


def brute(rows):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(b[s : s + L] for s in range(len(b) - L + 1))
    out = []
    for i, b in texts:
        covered = bytearray(len(b))
        for s in range(len(b) - L + 1):
            if seen[b[s : s + L]] > 1:
                covered[s : s + L] = b"\1" * L
        spans = sum(1 for k in range(len(b)) if covered[k] and (k == 0 or not covered[k - 1]))
        kept = bytes(c for c, x in zip(b, covered) if not x)
        out.append((i, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_documents(spark, sf_dir, rows):
    docs = table(spark, sf_dir, "documents").where("n_chars < 6000")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sum(w[2] for w in want) > 0
    assert rows(repeated_strings(docs).drop("spans")) == want


def test_awkward_texts(spark, rows, monkeypatch):
    monkeypatch.setattr(column_bwt, "COLLECTION", 8)
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choices("abcdé \n", k=n))

    p, q = noise(900), noise(380)
    data = [noise(500) + p + noise(30), p[:450] + noise(100), noise(50) + p[200:], p, p, q, q + "x", "z" + q]
    data += ["a" * 400, "a" * 401, "b" * 1200, "c" * 400, "x" + "c" * 400 + "y", "ab" * 700, "abc" * 300 + noise(20)]
    data += [None, "", "short", noise(50) + "d" * 380 + noise(40), (noise(7) + "-") * 300, p[:500] + p[:500]]
    for _ in range(25):
        t = list(p)
        t[rng.randrange(len(t))] = "#"
        data.append("".join(t))
    data = [(i, t) for i, t in enumerate(data)] + [(None, noise(450)), (3, p)]
    df = spark.createDataFrame([(*d, "s") for d in data], "doc_id long, text string, h string")
    assert rows(repeated_strings(df).drop("spans")) == brute(data)


def test_common_anchor(spark, rows, monkeypatch):
    """Many pieces around one line: no group that is ordered holds more than COLLECTION of them."""
    monkeypatch.setattr(column_bwt, "COLLECTION", 8)
    inner = column_bwt.ordered

    def watched(batches):
        def seen():
            names = {}
            for batch in batches:
                for anchor, name in zip(batch["anchor"], batch["name"]):
                    names.setdefault(anchor, set()).add(name)
                assert max(map(len, names.values())) <= 8, "a group is too large"
                yield batch

        return inner(seen())

    monkeypatch.setattr(column_bwt, "ordered", watched)
    rng = random.Random(7)

    def noise(n):
        return "".join(rng.choices("abcdefgh \n", k=n))

    data = []
    for line in (noise(150), noise(420), noise(700)):
        sides = [noise(350) for _ in range(4)]
        for i in range(40):
            before, after = noise(400), noise(400)
            if i % 3 == 0:
                before = (before + rng.choice(sides))[-400 - i :]
            if i % 4 == 0:
                after = rng.choice(sides)[: 100 + 7 * i] + after
            data.append(before + line + after)
        data += [line, line[:-3], noise(5) + line]
    data = [(i, t) for i, t in enumerate(data)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(repeated_strings(df).drop("spans")) == brute(data)


def test_columns_in_files(spark, rows, monkeypatch):
    monkeypatch.setattr(column_bwt, "SPILL", 0)
    columns = column_bwt.Columns()
    base = bytes(range(1, 251)) * 3
    columns.add([base[:700], base[:699] + b"!"], [0, 0])
    columns.add([b"#" + base[1:700]], [0])
    marks = column_bwt.repeated(columns)
    assert columns.file is not None
    assert marks[:, 0].all() and marks[:300, 1].all() and not marks[0, 2] and marks[1:, 2].all()


def test_empty_table(spark):
    assert repeated_strings(spark.createDataFrame([], "doc_id long, text string")).collect() == []
