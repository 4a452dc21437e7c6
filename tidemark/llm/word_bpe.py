"""Encoding with a word-level BPE file of the tokenizers library, many texts at a time.

The file's pre-tokenizer cuts a text into pieces (letter runs, single digits, punctuation runs,
a few contractions) and BPE works inside one piece, so a piece has the same ids wherever it
stands. Texts of plain Latin letters are cut here. Where the file is a plain byte-level one whose ids are
the order of its merges, a piece's end is one more byte to merge, before all others, and
tiktoken merges the pieces by rank, several times as fast as the library. Every other text goes to
the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from tidemark.llm.byte_bpe import byte_of

# The pre-tokenizer's pattern in the tokenizer file, for the characters of PLAIN.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

# Characters that NFC leaves alone, that lower-case one to one, and that both pattern engines
# put into the same classes: tab, line feed, carriage return, ASCII, Latin-1 and Latin
# Extended-A letters without superscript digits, fractions, no-break space and dotted I.
PLAIN = re.compile("[\t\n\r -~¡-±´-¸º-»¿-įı-ſ]*")

# The byte that stands for the end of a piece; no plain text holds it.
END = "\x01"
SUFFIX = "</w>"


def ranks(file: dict) -> dict[bytes, int] | None:
    """Bytes, with ``END`` for the end of a piece, -> id; None for a file that says anything else."""
    model = file.get("model") or {}
    if (
        model.get("type") != "BPE"
        or model.get("end_of_word_suffix") != SUFFIX
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        or "ByteLevel" not in json.dumps(file.get("pre_tokenizer"))
    ):
        return None
    vocab, letters, size = model["vocab"], byte_of(), 512 + len(model["merges"])
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    # A piece's last letter and its end are one from the start, so these merges come first.
    if any(vocab.get(a + b) != 512 + k for k, (a, b) in enumerate(pairs)) or any(
        vocab.get(c, size) > 511 or vocab.get(c + SUFFIX, size) > 511 or vocab[c] > 255 for c in letters
    ):
        return None
    out: dict[bytes, int] = {}
    for word, i in vocab.items():
        if i < size:
            body, end = (word[: -len(SUFFIX)], END) if word.endswith(SUFFIX) else (word, "")
            if not all(c in letters for c in body):
                return None
            out[bytes(letters[c] for c in body) + end.encode()] = i
    return out if len(out) == size else None


class WordBpe:
    """One tokenizer file in one Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.words = np.array(self.tokens, dtype=object)
        with open(path, encoding="utf-8") as f:
            known = ranks(json.load(f))
        self.fast = None
        if known is not None:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "words", pat_str=f"[^{END}]+{END}", mergeable_ranks=known, special_tokens={}
            )
            self.ends = np.array([t is not None and t.endswith(SUFFIX) for t in self.tokens])

    def plain(self, text: str) -> bool:
        return (
            self.fast is not None
            and PLAIN.fullmatch(text) is not None
            and not any(s in text for s in self.special)
        )

    def of_pieces(self, pieces: list[str]) -> np.ndarray:
        ids = self.fast.encode_ordinary(END.join([*pieces, ""]))
        return np.asarray(ids, "<u4")

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, little-endian unsigned 32-bit, without added special tokens."""
        if self.plain(text):
            return self.of_pieces(PIECES.findall(text.lower())).tobytes()
        return np.asarray(
            self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"
        ).tobytes()

    def encode_with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and the character of ``text`` at which each token starts."""
        if self.plain(text):
            pieces = list(PIECES.finditer(text.lower()))
            ids = self.of_pieces([m.group() for m in pieces])
            # Tokens inside a piece share its start: only piece starts are ever joints.
            sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            return ids, np.repeat(np.asarray([m.start() for m in pieces], np.int64), sizes)
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return np.asarray(e.ids, "<u4"), np.asarray([o[0] for o in e.offsets], np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode without skipping special tokens; the file has no decoder, for
        which the library joins the tokens by blanks. Unknown ids are left out, as it does."""
        return " ".join(self.words[ids[ids < len(self.words)]].tolist())


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """The tokenizer of this worker, loaded once."""
    return WordBpe(path)


def word_start(text: str, low: int, high: int) -> int | None:
    """First position in [low, high) at which a word starts: white space before it, none at it.

    Such a joint is stable: no piece, composition or special string crosses white space.
    """
    for p in range(max(low, 1), min(high, len(text))):
        if text[p - 1] in " \n\t\r" and not text[p].isspace():
            return p
    return None
