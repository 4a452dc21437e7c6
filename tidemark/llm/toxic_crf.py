"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Two tags, clean and toxic. Features of a word: itself, its first four and its first
five letters, the word before, the word after; plus tag transitions. A text is a set of lanes of ``CHAIN`` consecutive words, so that
forward-backward runs over all lanes of a batch at once; a lane also has ``CONTEXT`` words of the text on either side, which are
read but whose marginals are the neighbouring lane's, so a phrase scores the same wherever a text is cut.

Labels are given for documents only. Tokens are labelled from them: in the training sample a word
of a toxic document is tagged toxic if it, or one of its prefixes, occurs in toxic documents far beyond expectation,
counted by distinct contexts (neighbouring words), so that copies of one text count once. The
field is then fitted to the tagged tokens by conditional likelihood. A document's score is a
logistic function of its largest token marginal and of the expected number of toxic tokens,
fitted to the sample's document labels with weights that undo the balanced sampling.

The sample is bounded: at most ``train_docs`` labelled documents, half of either label, chosen
by a hash of the id, and of each a passage of at most ``train_chars`` characters.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")
CHAIN = 128
CONTEXT = 16
LANES = 2_048  # worked on at a time: some twenty arrays of that many lanes are held at once
BITS = 20
LEXICON = 60_000  # kinds with a weight of their own, below 2 ** BITS
ITERATIONS = 60
RESULT = "score double, spans array<struct<start: int, end: int, marginal: double>>"


@dataclass
class Field:
    """Weights: rows of ``emission`` are word, short prefix, long prefix, previous and next word;
    number 0 is any other kind."""

    kinds: dict[str, int]
    emission: np.ndarray  # (5, kinds + 1)
    bias: float
    transition: np.ndarray  # (2, 2) by tag before, tag after
    document: np.ndarray  # weights of the document score: constant, largest, expected


def lowered(text: str) -> str:
    """Lower case of the same length, so that offsets stay those of ``text``."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def prefixes(word: str) -> tuple[str, str]:
    """Kinds of words by their first letters, for words that are made from a stem."""
    return word[:4] + "~", word[:5] + "~~"


class KindIds(dict):
    """word -> the numbers of its three kinds in one integer; a bounded memo."""

    def __init__(self, kinds: dict[str, int]):
        super().__init__()
        self.kinds = kinds

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        get = self.kinds.get
        short, long = prefixes(word)
        self[word] = found = get(word, 0) | get(short, 0) << BITS | get(long, 0) << 2 * BITS
        return found


def packed(memo: KindIds, words: list[str]) -> np.ndarray:
    return np.asarray([memo[w] for w in words], np.int64)


def kinds_of(x: np.ndarray) -> list[np.ndarray]:
    """Numbers of the word, its short prefix and its long prefix; 0 below the end of a lane."""
    x = np.maximum(x, 0)
    return [(x >> (k * BITS)) & (2**BITS - 1) for k in range(3)]


def lanes(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts as columns of up to ``CHAIN`` words of its own (``core``) and ``CONTEXT`` more of
    the text on either side, -1 below the end; first lane of each text.

    Marginals are taken from the core alone: what lies beyond the context no longer moves them, so they don't
    depend on where a text is cut.
    """
    counts = np.asarray([-(-len(x) // CHAIN) for x in ids], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    height = CHAIN + 2 * CONTEXT
    out = np.full((int(first[-1]), height), -1, np.int64)
    core = np.zeros(out.shape, bool)
    for x, lane in zip(ids, first.tolist(), strict=False):
        for at in range(0, len(x), CHAIN):
            low = max(0, at - CONTEXT)
            part = x[low : at + CHAIN + CONTEXT]
            out[lane, : len(part)] = part
            core[lane, at - low : min(at + CHAIN, len(x)) - low] = True
            lane += 1
    return np.ascontiguousarray(out.T), first, np.ascontiguousarray(core.T)


def odds(field: Field, x: np.ndarray) -> np.ndarray:
    """exp of the emission score of tag toxic against clean; 1 below the end of a lane."""
    w, short, long = kinds_of(x)
    e = field.bias + field.emission[0][w] + field.emission[1][short] + field.emission[2][long]
    e[1:] += field.emission[3][w[:-1]]
    e[:-1] += field.emission[4][w[1:]]
    return np.exp(np.where(x >= 0, np.clip(e, -30, 30), 0))


def forward_backward(field: Field, x: np.ndarray, core: np.ndarray | None = None):
    """Marginals of tag toxic (0 below the end), and the sums of the pair marginals whose second
    word is in the ``core``, if that is given."""
    n, m = x.shape
    e, a = odds(field, x), np.exp(field.transition)
    f, b = np.empty((n, m)), np.empty((n, m))
    p = e[0] / (1 + e[0])
    f[0] = p
    for t in range(1, n):
        one = (p * a[1, 1] + (1 - p) * a[0, 1]) * e[t]
        p = one / (one + p * a[1, 0] + (1 - p) * a[0, 0])
        f[t] = p
    q = np.full(m, 0.5)
    b[n - 1] = q
    for t in range(n - 2, -1, -1):
        up, down = q * e[t + 1], 1 - q
        one = a[1, 1] * up + a[1, 0] * down
        # Beyond the end nothing is known: the message stays even.
        q = np.where(x[t + 1] >= 0, one / (one + a[0, 1] * up + a[0, 0] * down), 0.5)
        b[t] = q
    one = f * b
    marginal = np.where(x >= 0, one / (one + (1 - f) * (1 - b)), 0)
    if core is None:
        return marginal
    live = core[1:]
    joint = np.empty((2, 2, n - 1, m))
    for i, before in ((0, 1 - f[:-1]), (1, f[:-1])):
        joint[i, 0] = before * a[i, 0] * (1 - b[1:])
        joint[i, 1] = before * a[i, 1] * e[1:] * b[1:]
    joint = np.where(live, joint / joint.sum((0, 1)), 0)
    return marginal, joint.sum((2, 3))


class Sample:
    """Training texts as numbers of their words: each distinct word is kept once."""

    def __init__(self, rows: list[tuple[str, bool]]):
        number: dict[str, int] = {"": 0}
        self.words = [
            np.asarray([number.setdefault(w, len(number)) for w in WORD.findall(lowered(t))], np.int32)
            for t, _ in rows
        ]
        self.toxic = [y for _, y in rows]
        self.names = list(number)

    def packed(self, kinds: dict[str, int]) -> list[np.ndarray]:
        each = packed(KindIds(kinds), self.names)
        return [each[w] for w in self.words]


def toxic_kinds(sample: Sample) -> set[str]:
    """Words and prefixes that toxic texts hold far beyond expectation, by distinct contexts."""
    names = sample.names
    word = np.concatenate([np.append(w, 0) for w in sample.words]).astype(np.int64)
    y = np.repeat(np.asarray(sample.toxic, np.int8), [len(w) + 1 for w in sample.words])
    before, after = np.roll(word, 1), np.roll(word, -1)
    with np.errstate(over="ignore"):
        context = before * np.int64(0x9E3779B97F4A7C1) + after * np.int64(0x7F4A7C159E3779B)
    context = ((context ^ (context >> 29)) & 0xFFFFFF).astype(np.int64)
    found: set[str] = set()
    for level in range(3):
        kinds: dict[str, int] = {}
        of_word = np.asarray(
            [kinds.setdefault((n, *prefixes(n))[level], len(kinds)) for n in names], np.int64
        )
        counts = []
        for value in (0, 1):
            at = (y == value) & (word > 0)
            pairs = np.unique(of_word[word[at]] << 24 | context[at])
            counts.append(np.bincount(pairs >> 24, minlength=len(kinds)))
        clean, bad = counts
        totals = clean.sum() + 1, bad.sum() + 1
        expected = (clean + bad) * (totals[1] / sum(totals))
        ratio = (bad / totals[1]) / ((clean + 0.5) / totals[0])
        keep = (bad >= 4) & (bad - expected >= 3 * np.sqrt(expected)) & (ratio >= 8)
        listed = list(kinds)
        found.update(listed[i] for i in np.flatnonzero(keep) if listed[i].strip("~"))
    return found


def fitted_chains(sample: Sample) -> Field:
    """The field fitted to the tagged tokens by AdaGrad on the conditional likelihood."""
    if not any(len(w) for w in sample.words):
        return Field({}, np.zeros((5, 1)), -3.0, np.zeros((2, 2)), np.zeros(3))
    marked = toxic_kinds(sample)
    times = np.bincount(np.concatenate(sample.words), minlength=len(sample.names))
    counts: Counter = Counter()
    for name, n in zip(sample.names[1:], times[1:].tolist(), strict=True):
        for kind in (name, *prefixes(name)):
            counts[kind] += n
    ranked = sorted(counts, key=lambda k: (k not in marked, -counts[k], k))[:LEXICON]
    kinds = {k: i + 1 for i, k in enumerate(ranked)}
    size = len(kinds) + 1
    field = Field(kinds, np.zeros((5, size)), -3.0, np.zeros((2, 2)), np.zeros(3))
    is_marked = np.zeros(size, bool)
    is_marked[[kinds[k] for k in marked if k in kinds]] = True
    every, first, cores = lanes(sample.packed(kinds))
    lane_toxic = np.repeat(np.asarray(sample.toxic, bool), np.diff(first))
    parts = [slice(k, k + LANES) for k in range(0, every.shape[1], LANES)]
    square = [np.full_like(field.emission, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(ITERATIONS):
        grads, pairs, bias, off, total = -0.01 * field.emission, np.zeros((2, 2)), 0.0, 0.0, 0
        # A part of the lanes at a time, to bound memory.
        for part in parts:
            x, live = every[:, part], cores[:, part]
            each = kinds_of(x)
            y = (is_marked[each[0]] | is_marked[each[1]] | is_marked[each[2]]) & live & lane_toxic[part]
            p, joint = forward_backward(field, x, live)
            g = np.where(live, y - p, 0)
            w = each[0]
            for row, (at, values) in enumerate(
                [*((k, g) for k in each), (w[:-1], g[1:]), (w[1:], g[:-1])]
            ):
                grads[row] += np.bincount(at.ravel(), values.ravel(), size)
            seen = [[((y[:-1] == i) & (y[1:] == j) & live[1:]).sum() for j in (0, 1)] for i in (0, 1)]
            pairs += np.asarray(seen) - joint
            bias += float(g.sum())
            off += float(np.abs(g).sum())
            total += int(live.sum())
        grads[:, 0] = 0  # kinds outside the lexicon say nothing by themselves
        for value, grad, k in ((field.emission, grads, 0), (field.transition, pairs, 2)):
            square[k] += grad**2
            value += 0.5 * grad / np.sqrt(square[k])
        square[1] += bias**2
        field.bias += 0.5 * bias / np.sqrt(square[1])
        if off < 1e-4 * total:
            break
    return field


def document_features(field: Field, ids: list[np.ndarray]) -> tuple[np.ndarray, list]:
    """(constant, log odds of the largest marginal, log of 1 + expected toxic words) per text, and marginals."""
    x, _, core = lanes(ids)
    parts = [forward_backward(field, x[:, k : k + LANES]) for k in range(0, x.shape[1], LANES)]
    # Cores in the order of lanes are the words of the texts in their order.
    p = np.concatenate(parts, axis=1).T[core.T] if parts else np.zeros(0)
    ends = np.cumsum([len(v) for v in ids])
    out, each = np.zeros((len(ids), 3)), []
    for k, v in enumerate(ids):
        m = p[ends[k] - len(v) : ends[k]]
        top = np.clip(m.max(initial=0), 1e-4, 1 - 1e-4)
        # A word counts by how far it is beyond doubt, so long texts don't gather crumbs.
        out[k] = 1, np.log(top / (1 - top)), np.log1p(m[m > 0.1].sum())
        each.append(m)
    return out, each


def fitted_documents(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        w += np.linalg.solve(hessian, x.T @ (weight * (y - p)) - 0.1 * w)
    return w


def fit(
    docs: DataFrame, labels: DataFrame, train_docs: int = 4_000, train_chars: int = 50_000
) -> Field:
    """The field of ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``, from a bounded sample.

    NULL labels, NULL texts and ids that no document has are left out; without any label the
    field scores every text alike. The driver gets at most ``2 * train_docs`` rows, however often an
    id occurs, of at most ``train_chars`` characters, which start anywhere in a longer text, by its hash.
    """
    labels = labels.where("toxic is not null and doc_id is not null").select(
        "doc_id", (F.col("toxic") == 1).alias("toxic")
    ).distinct()
    counts = {r[0]: r[1] for r in labels.groupBy("toxic").count().collect()}
    ids = None
    for value in (True, False):
        part = labels.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(
            train_docs // 2
        )
        ids = part if ids is None else ids.unionByName(part)
    places = F.greatest(F.length("text") - train_chars, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("text"), places) + 1).cast("int")
    rows = (
        docs.select("doc_id", "text")
        .where("text is not null")
        # At most train_docs ids: a bounded side.
        .join(F.broadcast(ids), "doc_id")
        .select(F.col("text").cast("string").alias("text"), "toxic")
        .select(F.substring(F.col("text"), start, F.lit(train_chars)).alias("text"), "toxic")
        .orderBy(F.xxhash64("text"), "text", "toxic")
        .limit(2 * train_docs)
        .collect()
    )
    sample = Sample(sorted((r[0], r[1]) for r in rows))
    toxic = sample.toxic
    field = fitted_chains(sample)
    if rows:
        x, _ = document_features(field, sample.packed(field.kinds))
        y = np.asarray(toxic, float)
        n = {v: max(1, toxic.count(v)) for v in (True, False)}
        weight = np.asarray([counts.get(v, 0) / n[v] for v in toxic])
        field.document = fitted_documents(x, y, weight * len(rows) / max(1e-9, weight.sum()))
    return field


def scorer(spark, field: Field):
    """Column of texts -> struct of score and spans (code points) with a marginal above 0.5."""
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf(RESULT)
    def score(texts: pd.Series) -> pd.DataFrame:
        field = shared.value
        memo = KindIds(field.kinds)
        scores, spans = [], []
        group: list[str] = []
        size = 0

        def flush():
            x, each = document_features(field, [packed(memo, WORD.findall(lowered(t))) for t in group])
            scores.extend(1 / (1 + np.exp(-np.clip(x @ field.document, -30, 30))))
            for t, m in zip(group, each, strict=True):
                hits = np.flatnonzero(m > 0.5)
                at = [w.span() for w in WORD.finditer(lowered(t))] if len(hits) else []
                spans.append(
                    [{"start": at[i][0], "end": at[i][1], "marginal": float(m[i])} for i in hits]
                )

        for t in texts:
            group.append("" if t is None else t)
            size += len(group[-1])
            if size > 2_000_000:
                flush()
                group, size = [], 0
        flush()
        return pd.DataFrame({"score": scores, "spans": spans})

    return score


def toxicity(docs: DataFrame, field: Field, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted, spans)``, one row per row of ``docs(doc_id, text)``.

    Texts of any length are scored whole. NULL and empty texts have the score of a text without words. Repeated rows stay repeated, a
    NULL ``doc_id`` stays NULL, other columns are ignored; an empty table gives an empty result.
    """
    scored = docs.select("doc_id", scorer(docs.sparkSession, field)(F.col("text").cast("string")).alias("s"))
    return scored.select(
        "doc_id",
        "s.score",
        (F.col("s.score") >= threshold).cast("int").alias("predicted"),
        "s.spans",
    )
