"""Exact token counts of huge documents: overlapping chunks, spliced at stable joints.

A text longer than ``chunk_chars`` is cut into chunks that overlap by ``overlap_chars`` on either
side; each chunk is a row of its own, so one huge document is spread over many tasks. A chunk is
encoded with offsets. Around each joint both neighbours list the positions at which a word starts
(white space before, none at it) with the token that starts there. No piece of the
pre-tokenizer, no composition of the normaliser and no special string crosses white space, so a
position that both list with the same token is a stable common boundary: the splice goes there,
and each side counts its tokens up to it. A text with a joint at which no boundary agrees (one
unbroken word over the overlap, say) is cut again with chunks and overlaps four times as wide,
at the end as one chunk, which has no joint.

Results are a function of the text alone, so equal long texts are encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.llm.word_bpe import word_bpe

WIDEN = 4
CANDIDATES = "array<struct<pos: bigint, cum: bigint, token: bigint>>"


def counter(path: str):
    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        bpe = word_bpe(path)
        return pd.Series([None if t is None else len(bpe.encode(t)) // 4 for t in texts], dtype="Int64")

    return count


def slices(chunk: int, overlap: int):
    """(key, text) -> one row per chunk with its margins."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                n = len(text)
                count = max(1, -(-n // chunk))
                for i in range(count):
                    start = max(0, i * chunk - overlap)
                    end = n if i == count - 1 else min(n, (i + 1) * chunk + overlap)
                    yield pd.DataFrame(
                        {"key": [key], "i": [i], "n": [count], "start": [start],
                         "piece": [text[start:end]]}
                    )

    return run


def candidates(text: str, ids, starts, low: int, high: int, shift: int) -> list:
    """Word starts in [low, high) of a chunk with the tokens before them and the token at them."""
    found = []
    a, b = np.searchsorted(starts, (low, high))
    for t in range(int(a), int(b)):
        p = int(starts[t])
        # The first token at p, and white space right before it.
        if p > 0 and text[p - 1] in " \n\t\r" and (t == 0 or starts[t - 1] < p):
            found.append({"pos": p + shift, "cum": t, "token": int(ids[t])})
    return found


def encoded(path: str, chunk: int, overlap: int):
    """Chunks -> token totals and the candidates at their two joints."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = word_bpe(path)
        for batch in batches:
            rows = []
            for key, i, n, start, piece in batch.itertuples(index=False):
                ids, starts = bpe.encode_with_offsets(piece)
                joint, end = i * chunk - start, (i + 1) * chunk - start
                half = overlap // 2
                left = candidates(piece, ids, starts, joint - half, joint + half, start) if i else []
                right = (
                    candidates(piece, ids, starts, end - half, end + half, start)
                    if i < n - 1
                    else []
                )
                rows.append((key, i, n, len(ids), left, right))
            yield pd.DataFrame(rows, columns=["key", "i", "n", "total", "left", "right"])

    return run


def long_counts(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``(key, n_tokens)`` for texts ``(key, text)`` with distinct keys."""
    done = None
    while True:
        pieces = texts.mapInPandas(
            slices(chunk, overlap), "key string, i int, n int, start bigint, piece string"
        ).repartition("key", "i")
        chunks = pieces.mapInPandas(
            encoded(path, chunk, overlap),
            f"key string, i int, n int, total bigint, left {CANDIDATES}, right {CANDIDATES}",
        )
        # One row per chunk: chunk i meets chunk i + 1 by a self-join on (key, joint).
        chunks = saved(chunks, "chunks")
        before = chunks.select("key", F.col("i").alias("joint"), "right")
        after = chunks.where("i > 0").select("key", (F.col("i") - 1).alias("joint"), "left")
        spliced = before.join(after, ["key", "joint"]).select(
            "key",
            F.expr(
                "get(filter(transform(right, r -> struct(r.cum as upto, get(filter(left, l -> "
                "l.pos = r.pos and l.token = r.token), 0).cum as onwards)), "
                "s -> s.onwards is not null), 0)"
            ).alias("s"),
        )
        # Sum over chunks of (tokens up to the right splice - tokens before the left splice).
        joints = spliced.groupBy("key").agg(
            F.sum(F.col("s.upto") - F.col("s.onwards")).alias("at_joints"),
            F.max(F.col("s").isNull()).alias("failed"),
        )
        totals = chunks.groupBy("key").agg(
            F.sum(F.when(F.col("i") == F.col("n") - 1, F.col("total")).otherwise(0)).alias("last")
        )
        now = saved(
            totals.join(joints, "key", "left").select(
                "key",
                (F.col("last") + F.coalesce("at_joints", F.lit(0))).alias("n_tokens"),
                F.coalesce("failed", F.lit(False)).alias("failed"),
            ),
            "spliced",
        )
        good = now.where("not failed").select("key", "n_tokens")
        done = good if done is None else done.unionByName(good)
        if now.where("failed").isEmpty():
            return done
        texts = texts.join(now.where("failed").select("key"), "key", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def count_tokens(
    docs: DataFrame,
    path: str,
    chunk_chars: int = 32_768,
    overlap_chars: int = 1_024,
    limit: int = 2_048,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs(doc_id, text)``.

    A NULL text counts as empty (0 bytes, 0 tokens). Repeated rows stay repeated, a NULL
    ``doc_id`` stays NULL; other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    is_long = F.length("text") > chunk_chars
    short = rows.where(~is_long).select("doc_id", "n_bytes", counter(path)("text").alias("n_tokens"))
    keyed = rows.where(is_long).withColumn("key", F.sha2("text", 256))
    texts = saved(keyed.groupBy("key").agg(F.first("text").alias("text")), "long-texts")
    counts = long_counts(texts, path, chunk_chars, overlap_chars)
    long = keyed.select("key", "doc_id", "n_bytes").join(counts, "key").select(
        "doc_id", "n_bytes", "n_tokens"
    )
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
