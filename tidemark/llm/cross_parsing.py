"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds all substrings of a bounded training text. A document
is parsed from left to right into the longest phrases that occur in that text: the automaton is
followed until it has no transition, there a phrase ends and the next one starts. A language of
n training characters costs ``log2 n`` bits a phrase; the language with the fewest bits per
character, the cross-parsing entropy, wins.

Texts are lower-cased and every run of other than letters is one blank. Every letter of the training texts
is a symbol of its own; an automaton numbers the letters of its language, and with many of them (Chinese) its
transitions lie in one displaced table instead of a row for each state. Texts are parsed in blocks of ``BLOCK``
characters, so that many blocks advance together, and phrases go on across them: a block starts in the state in which the
characters before it, parsed from some way back, leave the automaton. Longest-match parses that start at different places soon
agree; where a block's start differs from its predecessor's end, the block is parsed again from there, until
all agree. The phrases are then those of the whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
LANES = 4_096
WARM_UP = 64  # characters before a block from which its start is guessed
DENSE = 1 << 23  # cells of a table with a row for each state
UNKNOWN = "und"
MOST_LANGUAGES = 10_000


class Displaced:
    """Transitions of an automaton over a large alphabet: the row of a state lies at its own offset
    in one table, between other rows, and a cell tells whose it is."""

    def __init__(self, to: list[dict[int, int]], size: int):
        self.size = size
        cells = max(size, 4 * sum(map(len, to)), 16)
        self.mask = (1 << (cells - 1).bit_length()) - 1
        self.offset = np.zeros(len(to), np.int64)
        self.owner = np.zeros(self.mask + 1, np.int32)  # state 0 has no transitions
        self.target = np.zeros(self.mask + 1, np.int32)
        taken = bytearray(self.mask + 1)
        at = 0
        # The longest rows first, while there is room; at most a quarter of the cells is ever taken.
        for state in sorted(range(len(to)), key=lambda q: -len(to[q])):
            row = to[state]
            if not row:
                break
            while any(taken[(at + c) & self.mask] for c in row):
                at = (at + 0x9E3779B1) & self.mask
            self.offset[state] = at
            for c, q in row.items():
                cell = (at + c) & self.mask
                taken[cell] = 1
                self.owner[cell], self.target[cell] = state, q

    def __len__(self) -> int:
        return len(self.offset)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states after ``c``, 0 for no transition; the last symbol stays."""
        cell = (self.offset[state] + c) & self.mask
        then = np.where(self.owner[cell] == state, self.target[cell], 0)
        return np.where(c == self.size - 1, state, then)


@dataclass
class Languages:
    """Automata of the learned languages over one alphabet of symbols.

    ``symbols`` maps a code point to 0 (no letter), 1 (a letter the training texts lack) or a
    letter's number; the last symbol, ``size - 1``, pads a block and leads every state to itself.
    ``numbers`` maps these to the symbols of each language, where letters it lacks are 1 too.
    """

    names: list[str]
    symbols: np.ndarray
    size: int
    numbers: list[np.ndarray]
    sizes: list[int]
    tables: list[np.ndarray | Displaced]  # (states, size), 0 for no transition, state 1 is the root
    lengths: list[int]


def suffix_automaton(s: np.ndarray, size: int) -> np.ndarray | Displaced:
    """Transitions of the suffix automaton of ``s``; row 1 is the root, row 0 no state."""
    most = 2 * len(s) + 2
    to: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in s.tolist():
        now = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in to[p]:
            to[p][c] = now
            p = link[p]
        if p:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    assert len(to) <= most
    if len(to) * size > DENSE:
        return Displaced(to, size)
    table = np.zeros((len(to), size), np.int32)
    for state, row in enumerate(to):
        table[state, list(row)] = list(row.values())
    return table


def symbols_of(text: str, symbols: np.ndarray) -> np.ndarray:
    """Symbols of a text, runs of no letters as one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = symbols[points]
    keep = s > 0
    keep[1:] |= s[:-1] > 0
    return s[keep]


def learn(rows: list[tuple[str, str]], train_chars: int) -> Languages:
    """From (lang, text) rows, in their order, up to ``train_chars`` characters per language."""
    by_lang: dict[str, list[str]] = {}
    for lang, text in rows:
        by_lang.setdefault(lang, []).append(text)
    names = sorted(by_lang)
    letters = Counter(c for texts in by_lang.values() for t in texts for c in t.lower() if c.isalpha())
    ranked = sorted(letters, key=lambda c: (-letters[c], c))
    symbols = np.zeros(0x110000, np.int32)
    symbols[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
    for i, c in enumerate(ranked):
        symbols[ord(c)] = i + 2
    size = len(ranked) + 3
    numbers, sizes, tables, lengths, used = [], [], [], [], []
    for name in names:
        s = np.concatenate([symbols_of(t + " ", symbols) for t in by_lang[name]])[:train_chars]
        if not (s > 0).any():
            continue
        own = np.unique(s[s > 1])
        number = np.ones(size, np.int32)
        number[0] = 0
        number[own] = np.arange(2, len(own) + 2)
        number[size - 1] = len(own) + 2
        table = suffix_automaton(number[s], len(own) + 3)
        if isinstance(table, np.ndarray):
            table[:, -1] = np.arange(len(table))
        numbers.append(number)
        sizes.append(len(own) + 3)
        tables.append(table)
        lengths.append(len(s))
        used.append(name)
    return Languages(used, symbols, size, numbers, sizes, tables, lengths)


def phrases(
    table: np.ndarray | Displaced, size: int, blocks: np.ndarray, state: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """How many phrases begin in each column of ``blocks`` besides the one that is open before it, and the
    state behind it; from ``state``, or the root. A letter that the training text lacks is a phrase of
    its own, and the next one begins behind it."""
    if isinstance(table, Displaced):
        step = table.step
        root = step(np.ones(size, np.int64), np.arange(size))
    else:
        flat = table.ravel()
        root = table[1]

        def step(state, c):
            return flat[state * size + c]

    lost = root == 0
    root = np.where(lost, 1, root)
    state = np.ones(blocks.shape[1], np.int64) if state is None else state
    count = np.zeros(blocks.shape[1], np.int32)
    for c in blocks:
        then = step(state, c)
        dead = then == 0
        count += dead
        count += dead & lost[c]
        state = np.where(dead, root[c], then).astype(np.int64)
    return count, state


def in_lanes(table, size: int, number: np.ndarray, blocks: np.ndarray, state: np.ndarray):
    """:func:`phrases` of any number of blocks, some thousands at a time."""
    count, end = np.zeros(blocks.shape[1], np.int32), np.zeros(blocks.shape[1], np.int64)
    for at in range(0, blocks.shape[1], LANES):
        part = slice(at, at + LANES)
        count[part], end[part] = phrases(table, size, number[blocks[:, part]], state[part])
    return count, end


def joined_phrases(table, size: int, number: np.ndarray, blocks: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Phrases that begin in each block, where a block that ``follows`` goes on with the one before it."""
    start = np.ones(blocks.shape[1], np.int64)
    after = np.flatnonzero(follows)
    if len(after):
        start[after] = in_lanes(table, size, number, blocks[-WARM_UP:, after - 1], start[after])[1]
    count, end = in_lanes(table, size, number, blocks, start)
    while len(after):
        # Only blocks behind one that has just been parsed can start elsewhere than it ends.
        after = after[start[after] != end[after - 1]]
        if not len(after):
            break
        start[after] = end[after - 1]
        count[after], end[after] = in_lanes(table, size, number, blocks[:, after], start[after])
        after = after + 1
        after = after[after < len(follows)]
        after = after[follows[after]]
    return count


def parse(model: Languages, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per symbol by text and language, and the number of symbols; 0 for no letters."""
    parts = [symbols_of(t, model.symbols) for t in texts]
    sizes = np.asarray([len(p) if (p > 0).any() else 0 for p in parts], np.int64)
    counts = -(-sizes // BLOCK)
    first = np.concatenate([[0], np.cumsum(counts)])
    flat = np.full(int(first[-1]) * BLOCK, model.size - 1, np.int32)
    for p, n, at in zip(parts, sizes, first, strict=False):
        if n:
            flat[at * BLOCK : at * BLOCK + n] = p
    blocks = np.ascontiguousarray(flat.reshape(-1, BLOCK).T)
    bits = np.zeros((len(texts), len(model.names)))
    owner = np.repeat(np.arange(len(texts)), counts)
    follows = np.zeros(len(owner), bool)
    follows[1:] = owner[1:] == owner[:-1]
    of_languages = zip(model.numbers, model.sizes, model.tables, model.lengths, strict=True)
    for k, (number, size, table, length) in enumerate(of_languages):
        found = joined_phrases(table, size, number, blocks, follows)
        # And the phrase that each text begins with.
        whole = np.bincount(owner, found, len(texts)) + (counts > 0)
        bits[:, k] = whole * np.log2(max(2, length))
    return bits / np.maximum(1, sizes)[:, None], sizes


def train(docs: DataFrame, train_docs: int = 400, train_chars: int = 40_000) -> Languages:
    """A model of ``docs(doc_id, text, lang)`` with a language.

    Per language a sample of at most ``train_docs`` rows, the first by a hash of id and text, and of each a passage of at most
    a tenth of ``train_chars`` characters that starts anywhere in it, by the same hash; so the driver gets at
    most ``train_docs * train_chars / 10`` characters a language. Rows without a language, text or id are
    left out, repeated rows are one; a table without any gives a model without languages. Languages are
    few: more than ``MOST_LANGUAGES`` fail.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null").select(
        "doc_id", "lang", F.col("text").cast("string").alias("text")
    )
    span = 2**31
    spread = known.withColumn("u", F.pmod(F.xxhash64("doc_id", "text"), F.lit(span)))
    # A row per language: their sizes set a threshold on the hash, which few rows pass, before any are
    # dealt by language and ranked.
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return learn([], train_chars)
    wanted = span * (2 * train_docs + 1_000)
    limit = F.element_at(F.create_map(*[F.lit(x) for n, k in sizes.items() for x in (n, wanted / k)]), F.col("lang"))
    chars = max(1, train_chars // 10)
    # Passages start by the hash at one of the places that leave room for a whole one.
    places = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    passage = F.substring(F.col("text"), (F.pmod(F.shiftright(F.xxhash64("text", "doc_id"), 3), places) + 1).cast("int"), F.lit(chars))
    some = spread.where(F.col("u") < limit).select("lang", "u", "doc_id", passage.alias("text")).distinct()
    order = Window.partitionBy("lang").orderBy("u", "doc_id", "text")
    rows = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= train_docs).collect()
    rows = sorted((r["u"], r["lang"], r["doc_id"], r["text"]) for r in rows)
    return learn([(lang, text) for _, lang, _, text in rows], train_chars)


def languages(docs: DataFrame, model: Languages) -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row per row of ``docs(doc_id, text)``.

    NULL texts and texts without a letter are ``und`` with score 0. Texts of any length are parsed
    whole. ``score`` (0 to 1) weighs the languages by their entropies; of equal ones the first by name is
    predicted. Repeated rows stay repeated, a NULL ``doc_id`` stays NULL, other
    columns are ignored, an empty table gives an empty result. A model without languages answers
    ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value

        def answer(texts):
            if not model.names:
                return [(UNKNOWN, 0.0)] * len(texts)
            bits, sizes = parse(model, texts)
            best = bits.argmin(axis=1)
            lead = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(sizes, 200)[:, None]
            score = 1 / np.exp2(-np.minimum(lead, 60)).sum(axis=1)
            return [
                (model.names[b], float(p)) if n else (UNKNOWN, 0.0)
                for b, p, n in zip(best, score, sizes, strict=True)
            ]

        for batch in batches:
            out, group, size = [], [], 0
            for t in batch["text"]:
                group.append(t or "")
                size += len(group[-1])
                if size > 2_000_000:
                    out += answer(group)
                    group, size = [], 0
            out += answer(group)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [o[0] for o in out],
                 "score": [o[1] for o in out]}
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInPandas(run, "doc_id bigint, lang_pred string, score double")
