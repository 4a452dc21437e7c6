"""Merkle trees in van Emde Boas order against trees built level by level."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import compare
from tidemark.llm import merkle_layout as M


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """All levels of a tree, from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[a : a + 8]) for a in range(0, len(low), 8)])
    return levels


def proof(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // 8 * 8
        out += [x for k, x in enumerate(nodes[start : start + 8], start) if k != i]
        i //= 8
    return out


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def want(rows, fields, change):
    """(id, leaf, subroot, root, proof, folded, verified) of rows (id, lang, ...), by brute force."""
    leaf = {k: h(*[field(r[f]) for f in fields]) for k, r in enumerate(rows)}
    by = {}
    for k, r in enumerate(rows):
        by.setdefault(r[1], []).append(k)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by[lang].sort(key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf[k]))
    trees = [tree([leaf[k] for k in by[lang]]) for lang in langs]
    upper = tree([t[-1][0] for t in trees])
    out = []
    for n, lang in enumerate(langs):
        for i, k in enumerate(by[lang]):
            now = change(rows[k])
            low = [list(x) for x in trees[n]]
            low[0][i] = h(*[field(now[f]) for f in fields])
            at = i
            for d in range(1, len(low)):
                at //= 8
                low[d][at] = h(*low[d - 1][at * 8 : at * 8 + 8])
            high = [list(x) for x in upper]
            high[0][n], at = low[-1][0], n
            for d in range(1, len(high)):
                at //= 8
                high[d][at] = h(*high[d - 1][at * 8 : at * 8 + 8])
            sides = proof(trees[n], i) + proof(upper, n)
            root = upper[-1][0]
            out.append((rows[k][0], leaf[k], trees[n][-1][0], root, h(*sides), high[-1][0], high[-1][0] == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", range(1, 6))
def test_addresses_are_a_permutation_and_halves_are_contiguous(levels):
    spots = np.concatenate([M.address(levels, d, np.arange(8**d)) for d in range(levels)])
    assert sorted(spots) == list(range(M.span(levels)))
    if levels > 1:
        top = levels // 2
        lower = np.concatenate([M.address(levels, d, np.arange(8 ** (d - top))) for d in range(top, levels)])
        assert sorted(lower) == list(range(M.span(top), M.span(top) + M.span(levels - top)))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 500, 512])
def test_block_against_levels(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = tree(leaves)
    slots = bytearray(M.span(len(levels)) * M.SIZE)
    root = M.build(slots, len(levels), 0, bytes.fromhex("".join(leaves)))
    assert root.hex() == levels[-1][0]
    rows = M.rows_of(bytes(slots), len(levels), n)
    for i in range(n):
        steps = M.siblings(rows, i)
        assert "".join(x.hex() for _, x in M.unpacked(M.packed(steps))) == "".join(proof(levels, i))
        assert M.folded(bytes.fromhex(leaves[i]), steps) == root


def lowered(r):
    return (*r[:2], r[2].lower() if r[2] and r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0 else r[2], *r[3:])


def test_several_rounds_of_blocks(spark):
    """One group of three rounds, small ones, a NULL one; NULL and repeated keys, repeated rows, clashing columns."""
    r = random.Random(5)
    rows = [(i, "a", f"Text {i}", 1, "x") for i in range(3_000)] + [(i, None, None, 2, "x") for i in range(515)]
    rows += [(i, lang, "Über Ñ", 3, "x") for i, lang in enumerate(["z", "é", "", "zz", *map(str, range(30))])]
    rows += [(None, "b", "X", 4, "x"), (None, "b", "Y", 4, "x"), (5, "b", "Q", 4, "x"), (5, "b", "Q", 4, "x"), (5, "b", "R", 4, "x")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, leaf int, rank string").repartition(5)
    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    now = {"text": F.when(third, F.lower("text")).otherwise(F.col("text"))}
    got = M.audited(df, ["doc_id", "lang", "text"], "lang", "doc_id", now)
    # Three hash levels a block: narrower blocks give the same tree.
    assert sorted(map(tuple, got.collect()), key=repr) == want(rows, [0, 1, 2], lowered)


def test_rounds_above_rounds(spark, monkeypatch):
    """Blocks of one hash level, so that a few hundred rows need several rounds, above the groups too."""
    monkeypatch.setattr(M, "HEIGHT", 1)
    monkeypatch.setattr(M, "WIDTH", 8)
    rows = [(i, f"g{i % 70}" if i < 140 else "h", "T", 0) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, n int")
    got = M.audited(df, ["doc_id", "lang", "text"], "lang", "doc_id")
    assert sorted(map(tuple, got.collect()), key=repr) == want(rows, [0, 1, 2], lambda r: r)
    assert got.where("not verified").count() == 0


def test_empty_and_single(spark):
    df = spark.createDataFrame([(1, None, "A")], "doc_id long, lang string, text string")
    assert M.audited(df.limit(0), ["doc_id", "lang", "text"], "lang", "doc_id").collect() == []
    (one,) = M.audited(df, ["doc_id", "lang", "text"], "lang", "doc_id").collect()
    assert one["leaf"] == one["subroot"] == one["root"] == h("1:1", "-", "1:A") and one["proof_sha256"] == h("")
    assert one["verified"]


def test_query_against_sql(spark, sf_dir):
    assert compare.check(spark, compare.duck(sf_dir), "op12_merkle_layout", sf_dir) is None
