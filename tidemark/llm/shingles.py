"""Word shingles of many texts at a time, as 64-bit hashes.

Words are runs of bytes other than blank and 9 to 13, with A-Z lower-cased. Hashes are the same
in every worker: polynomials over the bytes of a word, mixed, and polynomials over the words of
a shingle, mixed again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
STEP = np.uint64(0xD6E8FEB86659FD93)
# Each byte of a block is several 8-byte numbers for a while, and a worker keeps what it once took.
BLOCK_BYTES = 1 << 18

_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64; kept up to a few blocks."""
    have = _powers[base]
    if len(have) < n:
        size = 1 << (n - 1).bit_length()
        more = np.full(size, base, np.uint64)
        more[0] = 1
        have = np.multiply.accumulate(more)
        if size <= 8 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of ``data``, and where each starts and ends."""
    a = np.frombuffer(data, np.uint8)
    word = np.concatenate([[False], (a != 32) & ((a < 9) | (a > 13)), [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    with np.errstate(over="ignore"):
        terms = (a.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(a))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        h = (total[end] - total[start]) * powers(INVERSE, len(a))[start]
        return mixed(h + (end - start).astype(np.uint64)), start, end


def combined(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` words."""
    with np.errstate(over="ignore"):
        n = len(h) - k + 1
        out = np.full(n, np.uint64(k))
        for i in range(k):
            out = out * STEP + h[i : i + n]
        return mixed(out)


def lowered(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def blocks(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of several texts at a time, and the number of words of each, in order."""
    group: list[bytes] = []
    size = 0

    def words():
        data = b"\n".join(group)
        h, start, _ = word_hashes(data)
        ends = np.cumsum([len(x) + 1 for x in group])
        return h, np.diff(np.searchsorted(start, ends), prepend=0)

    for t in texts:
        group.append(lowered(t))
        size += len(group[-1])
        if size >= BLOCK_BYTES:
            yield words()
            group, size = [], 0
    if group:
        yield words()


def shingle_sets(texts, k: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted; of fewer than ``k`` words the whole sequence
    is one shingle, without words there is none."""
    for h, counts in blocks(texts):
        every = combined(h, k) if len(h) >= k else np.zeros(0, np.uint64)
        at = 0
        for c in counts.tolist():
            if c >= k:
                yield np.unique(every[at : at + c - k + 1])
            elif c:
                yield combined(h[at : at + c], c)
            else:
                yield np.zeros(0, np.uint64)
            at += c
