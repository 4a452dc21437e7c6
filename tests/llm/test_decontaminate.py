"""Windows like benchmark items, against every window and every item."""

import random
import re
import string
from collections import Counter

from tidemark.llm.common import table
from tidemark.llm.decontaminate import decontaminated, leaks


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower().translate({ord(c): " " for c in string.punctuation}))


def bag(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, least=0.8):
    out = []
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            b = bag(v, k)
            best = None
            if not set(b) & set(bag(w, k)):
                continue
            for s in range(max(1, len(w) - len(v) + 1)):
                x = bag(w[s : s + len(v)], k)
                both = sum((x & b).values())
                sim = both / (sum(x.values()) + sum(b.values()) - both)
                if sim >= least and (best is None or sim > best[0]):
                    best = sim, s
            if best:
                out.append((d, i, best[0], best[1], len(v)))
    return sorted(out, key=repr)


def test_documents(spark, sf_dir, rows):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                 [tuple(r) for r in items.select("item_id", "text").collect()])
    assert want and rows(leaks(docs, items)) == want
    assert rows(leaks(docs, items, items_per_pass=7)) == want
    kept = {r[0] for r in decontaminated(docs, items).select("doc_id").collect()}
    assert kept == {r[0] for r in docs.select("doc_id").collect()} - {w[0] for w in want}


def test_edited_passages(spark, rows):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "..."), (items[0]), (93, "a a a a a a a a")]
    docs = []
    for d in range(120):
        text = rng.choices(vocabulary, k=rng.randint(0, 80))
        passage = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randint(0, 2)):
            if passage:
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
        docs.append((d, " ".join(text + passage[rng.randint(0, 2):] + rng.choices(vocabulary, k=9)).upper()))
    docs += [(500, None), (501, ""), (None, items[3][1]), docs[7], (502, "a " * 50), (503, items[4][1] + "! " * 4)]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert rows(leaks(d, b)) == brute(docs, list(dict.fromkeys(items)))


def test_empty_tables(spark, rows):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert rows(leaks(d, b)) == [] and rows(leaks(one, b)) == []
    assert rows(decontaminated(one, b)) == [(1, "a b c d e f g")]
