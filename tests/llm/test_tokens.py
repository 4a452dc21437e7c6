"""Token counts and chunked encoding against the library, on whole and on awkward texts."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.chunk_bpe import cuts, decode, digests, encode
from tidemark.llm.common import table
from tidemark.llm.token_counts import count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")

WORDS = "The quick brown fox's 12 jumps, over 3.14 lazy-dogs; naïve Ångström straße! " * 400
AWKWARD = [
    None,
    "",
    " ",
    "a",
    "x" * 9_000,
    "ab" * 5_000 + " end",
    WORDS,
    WORDS,
    "pre " + WORDS + " post",
    WORDS[:3_000] + "<|endoftext|>" + WORDS,
    "<|startoftext|>x<|endoftext|>",
    "é café İstanbul ΣΣ 中文 한국 \U0001f600\U0001f601 " * 300,
    "x² ½  y\x1cz\x85w _a_b__ 'S'T'RE don't",
    "\t\n\r  mixed \n\n white\tspace ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, 7) for i, t in enumerate(AWKWARD)] + [(None, "no id", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_of_awkward_texts(spark, awkward, library):
    got = {r[0]: r for r in count_tokens(awkward, PATH, 512, 64).collect()}
    for i, t in enumerate(AWKWARD):
        n = len(ids_of(library, t))
        assert tuple(got[i]) == (i, len((t or "").encode()), n, n > 2048), i
    assert len(got) == len(AWKWARD) + 1 and got[None]["n_tokens"] == len(ids_of(library, "no id"))


def test_counts_of_documents(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    want = {r[0]: len(ids_of(library, r[1])) for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, PATH, 2_000, 100).collect()}
    assert got == want


def test_encoding_of_awkward_texts(spark, awkward, library):
    got = {r[0]: bytes(r[1]) for r in encode(awkward, PATH).collect()}
    for i, t in enumerate(AWKWARD):
        assert got[i] == np.asarray(ids_of(library, t), "<u4").tobytes(), i
    back = {r[0]: r[1] for r in decode(encode(awkward, PATH), PATH).collect()}
    for i, t in enumerate(AWKWARD):
        assert back[i] == library.decode(ids_of(library, t), skip_special_tokens=False), i


@pytest.mark.parametrize("chunks", [0, 5, 10_000])
def test_digests_of_documents(spark, sf_dir, library, chunks):
    docs = table(spark, sf_dir, "documents")
    got = {r[0]: tuple(r)[1:] for r in digests(docs, PATH, chunks).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = ids_of(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (
            len(ids),
            hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def test_chunks_follow_content():
    passage = " ".join(f"word{i * i}" for i in range(3_000))
    a, b = cuts(passage), cuts("Something before it. " + passage)
    shift = len("Something before it. ")
    assert len(set(a) & {x - shift for x in b}) > len(a) // 2
    assert cuts("") == [] and cuts("abc") == [3] and cuts("z" * 10_000)[-1] == 10_000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(empty, PATH).collect() == []
    assert digests(empty, PATH).collect() == []
