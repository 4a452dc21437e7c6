"""Encoding with a byte-level BPE file of the tokenizers library.

Where the file is a plain byte-level one whose merges make the ids 256, 257, ... in order, ranks of
bytes say the same, and tiktoken merges them several times as fast. Every other file, and texts
that hold a special string, go to the tokenizers library.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

# Fixed value: the pattern of the library's ByteLevel pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of() -> dict[str, int]:
    """Letter of a byte-level vocabulary -> its byte: printable ones stand for themselves, the
    others take the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ranks(file: dict) -> dict[bytes, int] | None:
    """Bytes -> id, if the file says no more than that."""
    pre, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
    if (
        file.get("normalizer") is not None
        or pre.get("type") != "ByteLevel"
        or pre.get("add_prefix_space")
        or not pre.get("use_regex", True)
        or model.get("type") != "BPE"
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    ):
        return None
    vocab, letters = model["vocab"], byte_of()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    words = [w for w, i in vocab.items() if i < 256 + len(pairs)]
    if len(words) != 256 + len(pairs) or not all(c in letters for w in words for c in w):
        return None
    return {bytes(letters[c] for c in w): vocab[w] for w in words}


class ByteBpe:
    """One tokenizer file in one Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            known = ranks(json.load(f))
        self.fast = None
        if known is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=known, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, little-endian unsigned 32-bit, without added special tokens; special
        strings inside it by the library's default."""
        if self.fast is not None and not any(s in text for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """The tokenizer of this worker, loaded once."""
    return ByteBpe(path)
