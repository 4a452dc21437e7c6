"""BPE encoding and decoding with content-defined chunks that are encoded once.

Chunks end where a rolling hash of the last characters has a fixed pattern, so equal passages in
different documents have equal chunks wherever they stand. One pass counts the chunks of all
documents by hash; the most rewarding ones that occur more than once form the dictionary, of at
most ``dictionary_chunks`` chunks (the bound of what is broadcast; chunks beyond it are encoded where they
stand, with the same ids). Spark encodes each dictionary chunk once.

A chunk's ids are valid from the first word start in it to the last one; what lies between two
reused chunks, or around one, is the joint and is encoded again. The joint is encoded together
with the first word of the chunk after it and must give that word's ids; if it does not, the
joint is widened over that chunk and the chunk isn't reused. Ids are thus those of the whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.llm.word_bpe import word_bpe, word_start

WINDOW = 32
MIN_CHARS, MAX_CHARS = 256, 4_096
# A joint ends a chunk where the hash's low bits are zero: about one character in 1,024.
MASK = np.uint64(1_023)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _gear() -> np.ndarray:
    """A fixed pseudo-random number for each of 256 character classes."""
    with np.errstate(over="ignore"):
        return _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


GEAR = _gear()


def cuts(text: str) -> list[int]:
    """Ends of the chunks of ``text``; the last one is its length."""
    n = len(text)
    if n <= MIN_CHARS:
        return [n] if n else []
    values = GEAR[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") & 255]
    with np.errstate(over="ignore"):
        # h[i] = sum over the window of values[i - k] << k, built by doubling.
        h, width = values.copy(), 1
        while width < WINDOW:
            shifted = np.zeros_like(h)
            shifted[width:] = h[:-width] << np.uint64(width)
            h, width = h + shifted, width * 2
        h = _mixed(h)
    marks = np.flatnonzero((h & MASK) == 0) + 1
    ends, at = [], 0
    while n - at > MIN_CHARS:
        k = int(np.searchsorted(marks, at + MIN_CHARS))
        nxt = int(marks[k]) if k < len(marks) else n
        at = min(nxt, at + MAX_CHARS, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunk_key(chunk: str) -> bytes:
    return hashlib.blake2b(chunk.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def chunk_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """text -> (key, n_chars, times) with a batch's repeats counted."""
    for batch in batches:
        seen: dict[bytes, list[int]] = {}
        for text in batch["text"]:
            at = 0
            for end in cuts(text):
                entry = seen.setdefault(chunk_key(text[at:end]), [end - at, 0])
                entry[1] += 1
                at = end
        if not seen:
            continue
        yield pd.DataFrame(
            {"key": list(seen), "n_chars": [e[0] for e in seen.values()],
             "times": [e[1] for e in seen.values()]}
        )


def chunk_texts(wanted):
    """text -> the chunks whose key is in the broadcast set, once per batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = wanted.value
        for batch in batches:
            found: dict[bytes, str] = {}
            for text in batch["text"]:
                at = 0
                for end in cuts(text):
                    key = chunk_key(text[at:end])
                    if key in keys and key not in found:
                        found[key] = text[at:end]
                    at = end
            if found:
                yield pd.DataFrame({"key": list(found), "chunk": list(found.values())})

    return run


def encoded_chunks(path: str):
    """chunk -> where its stable part starts, where the next word starts, where the stable part
    ends, and its ids; chunks without two word starts aren't reusable and are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = word_bpe(path)
        for batch in batches:
            rows = []
            for key, chunk in zip(batch["key"], batch["chunk"], strict=True):
                start = word_start(chunk, 1, len(chunk))
                second = word_start(chunk, (start or 0) + 1, len(chunk))
                last = next(
                    (p for p in range(len(chunk) - 1, second or len(chunk), -1)
                     if word_start(chunk, p, p + 1)), None
                )
                if start is not None and second is not None and last is not None:
                    ids = bpe.encode(chunk[start:last])
                    rows.append((key, start, second, last, len(bpe.encode(chunk[start:second])), ids))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "start", "second", "last", "probe", "ids"])

    return run


def dictionary(docs: DataFrame, path: str, dictionary_chunks: int) -> dict:
    """key -> (start, second, last, probe bytes, ids) of the most rewarding repeated chunks.

    Bounded by ``dictionary_chunks`` entries of at most ``MAX_CHARS`` characters each.
    """
    spark = docs.sparkSession
    texts = docs.select("text")
    counts = (
        texts.mapInPandas(chunk_rows, "key binary, n_chars bigint, times bigint")
        .groupBy("key")
        .agg(F.max("n_chars").alias("n_chars"), F.sum("times").alias("times"))
        .where("times > 1")
        .orderBy((F.col("times") * F.col("n_chars")).desc(), "key")
        .limit(dictionary_chunks)
    )
    keys = {bytes(r["key"]) for r in counts.select("key").collect()}
    if not keys:
        return {}
    wanted = spark.sparkContext.broadcast(keys)
    chunks = texts.mapInPandas(chunk_texts(wanted), "key binary, chunk string").groupBy("key").agg(
        F.first("chunk").alias("chunk")
    )
    ready = saved(
        chunks.mapInPandas(
            encoded_chunks(path),
            "key binary, start int, second int, last int, probe int, ids binary",
        ),
        "chunk-ids",
    )
    return {bytes(r[0]): (r[1], r[2], r[3], r[4], bytes(r[5])) for r in ready.collect()}


def spliced(bpe, text: str, known: dict) -> bytes:
    """The ids of ``text``, with the ids of known chunks reused and the joints encoded again."""
    if not known:
        return bpe.encode(text)
    parts, done, at = [], 0, 0
    for end in cuts(text):
        entry = known.get(chunk_key(text[at:end]))
        if entry is not None:
            start, second, last, probe, ids = entry
            # The joint and the chunk's first word together: the word's ids must come out again.
            joint = bpe.encode(text[done : at + second])
            if joint[len(joint) - probe :] == ids[:probe] and len(joint) >= probe:
                parts.append(joint)
                parts.append(ids[probe:])
                done = at + last
        at = end
    parts.append(bpe.encode(text[done:]))
    return b"".join(parts)


def encode(
    docs: DataFrame, path: str, dictionary_chunks: int = 16_384, with_text: bool = False
) -> DataFrame:
    """``(doc_id, ids)``, one row per row of ``docs(doc_id, text)``; ids are little-endian
    unsigned 32-bit integers, ``with_text`` keeps the text beside them.

    A NULL text counts as empty and has no ids. Repeated rows stay repeated, a NULL ``doc_id``
    stays NULL, other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = spark.sparkContext.broadcast(dictionary(rows, path, dictionary_chunks))

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        bpe = word_bpe(path)
        return pd.Series([spliced(bpe, t, known.value) for t in texts], dtype=object)

    kept = ["doc_id", "text"] if with_text else ["doc_id"]
    return rows.select(*kept, ids("text").alias("ids"))


def decoder(path: str):
    """Column of ids -> text, as the library decodes without skipping special tokens."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        bpe = word_bpe(path)
        return pd.Series(
            [None if b is None else bpe.decode(np.frombuffer(b, "<u4")) for b in ids], dtype=object
        )

    return decode


def decode(encodings: DataFrame, path: str) -> DataFrame:
    """``(doc_id, decoded)`` for ``(doc_id, ids)``; NULL ids give NULL, no ids an empty text."""
    return encodings.select("doc_id", decoder(path)("ids").alias("decoded"))


def digests(docs: DataFrame, path: str, dictionary_chunks: int = 16_384) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of :func:`encode` and :func:`decode`."""
    return (
        encode(docs, path, dictionary_chunks)
        .withColumn("decoded", decoder(path)("ids"))
        .select(
            "doc_id",
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.sha2("ids", 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256"),
        )
    )
