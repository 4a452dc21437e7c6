"""Quality scores from weak labels.

Several overlapping heuristics each call a text good (1), bad (-1) or abstain (0). The votes of all
documents are counted by pattern; expectation-maximisation over the patterns estimates how often
quality text occurs and how each heuristic votes on good and on bad text, without any label. The
posterior of each pattern then labels a bounded sample of documents softly, and a linear scorer
over hashed words and byte trigrams is fitted to it; the scorer rates every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import word_hashes

DIMENSIONS = 1 << 18
DOUBLED = re.compile(rb"([!?#$%&*+=~^_|<>-])\1")
MARKS = np.zeros(256, np.int8)
MARKS[list(b"!#$%&*+/<=>@\\^_`{|}~")] = 1
UPPER = np.zeros(256, np.int8)
UPPER[65:91] = 1
LETTER = np.zeros(256, np.int8)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def call(bad: bool, good: bool) -> int:
    return -1 if bad else 1 if good else 0


def votes(text: str | None) -> list[int]:
    """The votes of the heuristics on one text; empty texts are bad to all that have a say."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), max(1, len(data))
    a = np.frombuffer(data, np.uint8)
    marks, letters, upper = int(MARKS[a].sum()), int(LETTER[a].sum()), int(UPPER[a].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    distinct_lines = len(set(lines)) / max(1, len(lines))
    distinct = len(set(words)) / max(1, n)
    mean = sum(map(len, words)) / max(1, n)
    doubled = len(DOUBLED.findall(data)) / max(1, n)
    stops = (data.count(b".") + data.count(b"?")) / max(1, n)
    bars = (data.count(b"|") + data.count(b"\t")) / max(1, n)
    shouting = upper / max(1, letters)
    return [
        call(n < 8, n >= 30),
        call(marks / size > 0.04, marks / size < 0.005),
        call(shouting > 0.3, 0 < shouting < 0.1),
        call(distinct_lines < 0.7, len(lines) > 2 and distinct_lines > 0.95),
        call(n >= 20 and distinct < 0.35, n >= 20 and distinct > 0.5),
        call(mean < 2.5 or mean > 14, 3.5 <= mean <= 9),
        call(doubled > 0.05, doubled == 0),
        call(n >= 30 and stops < 0.005, 0.02 <= stops <= 0.25),
        call(bars > 0.1, bars == 0),
        call(letters / size < 0.6, letters / size > 0.75),
    ]


LABELLERS = 10


def pattern(text: str | None) -> int:
    """The votes as one number to base 3."""
    out = 0
    for v in votes(text):
        out = out * 3 + v + 1
    return out


def digits(patterns: np.ndarray) -> np.ndarray:
    """(patterns, labellers) of 0 bad, 1 abstain, 2 good."""
    return patterns[:, None] // 3 ** np.arange(LABELLERS - 1, -1, -1) % 3


@dataclass
class LabelModel:
    """Share of good text and each labeller's votes by class: ``rates[class, labeller, vote]``."""

    prior: float
    rates: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        d = digits(np.asarray(patterns, np.int64))
        at = np.arange(LABELLERS)
        logs = np.log(self.rates)
        good = np.log(self.prior) + logs[1, at, d].sum(axis=1)
        bad = np.log(1 - self.prior) + logs[0, at, d].sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation from the majority vote; rates are smoothed by one vote of each."""
    d = digits(np.asarray(patterns, np.int64))
    counts = np.asarray(counts, float)
    p = 1 / (1 + np.exp(-2.0 * (d - 1).sum(axis=1)))
    model = LabelModel(0.5, np.full((2, LABELLERS, 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p])
        rates = np.ones((2, LABELLERS, 3))
        for v in range(3):
            rates[:, :, v] += weight @ (d == v)
        rates /= rates.sum(axis=2, keepdims=True)
        prior = float(np.clip(weight[1].sum() / max(1e-9, counts.sum()), 1e-3, 1 - 1e-3))
        model = LabelModel(prior, rates)
        now = model.posterior(patterns)
        if np.abs(now - p).max(initial=0) < 1e-6:
            break
        p = now
    return model


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and byte trigrams of a text with weights of unit length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words, _, _ = word_hashes(data.lower())
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    grams = a[:-2] << np.uint64(16) | a[1:-1] << np.uint64(8) | a[2:]
    grams = (grams * np.uint64(0x9E3779B1)) >> np.uint64(7)
    h = np.concatenate([words, grams]) & np.uint64(DIMENSIONS - 1)
    at, n = np.unique(h.astype(np.int64), return_counts=True)
    w = np.sqrt(n)
    return at, w / max(1e-9, np.sqrt((w**2).sum()))


def scorer(samples: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 8) -> np.ndarray:
    """Weights (the last is the constant) by AdaGrad on the soft logistic loss."""
    w, square = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            at, x = samples[i]
            g = 1 / (1 + np.exp(-np.clip(w[at] @ x + w[-1], -30, 30))) - target[i]
            square[at] += (g * x) ** 2
            square[-1] += g * g
            w[at] -= 0.3 * (g * x + 1e-5 * w[at]) / np.sqrt(square[at])
            w[-1] -= 0.3 * g / np.sqrt(square[-1])
    return w


def fit(docs: DataFrame, train_docs: int = 4_000) -> tuple[LabelModel, np.ndarray]:
    """The label model of all ``docs(doc_id, text)`` and the scorer of at most ``train_docs`` of them."""

    @F.pandas_udf("int")
    def patterns(texts: pd.Series) -> pd.Series:
        return texts.map(pattern, na_action=None).astype("int32")

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counted = texts.select(patterns("text").alias("p")).groupBy("p").count().collect()
    # At most 3 ** LABELLERS rows.
    model = estimate(np.asarray([r[0] for r in counted], np.int64), [r[1] for r in counted])
    ids = texts.where("doc_id is not null").select("doc_id").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(train_docs)

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(pattern(t), *features(t)) for t in batch["text"]]
            yield pd.DataFrame(
                {"p": [r[0] for r in rows], "at": [r[1].astype("<i4").tobytes() for r in rows],
                 "x": [r[2].astype("<f4").tobytes() for r in rows]}
            )

    rows = (
        texts.join(F.broadcast(ids), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .select("text")
        .mapInPandas(sampled, "p int, at binary, x binary")
        .collect()
    )
    samples = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["x"], "<f4")) for r in rows]
    target = model.posterior(np.asarray([r["p"] for r in rows], np.int64)) if rows else np.zeros(0)
    return model, scorer(samples, target)


def quality(docs: DataFrame, model: LabelModel, weights: np.ndarray) -> DataFrame:
    """``(doc_id, score, predicted, weak_label)``, one row per row of ``docs(doc_id, text)``.

    ``score`` (0 to 1) is the scorer's, ``predicted`` 1 from 0.5, ``weak_label`` the posterior of
    the votes. NULL texts are empty ones. Repeated rows stay repeated, a NULL ``doc_id`` stays
    NULL, other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    @F.pandas_udf("score double, weak_label double")
    def score(texts: pd.Series) -> pd.DataFrame:
        model, w = shared.value
        p = np.asarray([pattern(t) for t in texts], np.int64)
        z = np.asarray([w[at] @ x + w[-1] for at, x in map(features, texts)])
        return pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "weak_label": model.posterior(p)})

    return docs.select("doc_id", score(F.col("text").cast("string")).alias("s")).select(
        "doc_id", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.weak_label"
    )
