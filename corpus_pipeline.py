"""A training corpus from raw documents: each stage's rows are written and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chunk_bpe, decontaminate, secret_ledger, toxic_crf
from tidemark.llm.common import saved, table
from tidemark.llm.one_of_each import one_of_each

THRESHOLD = 0.7
WORDS, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold.

    Texts are scored whole; a NULL or empty one has no toxic word and stays. Repeated rows go or stay
    together, NULL ids count as others; an empty table stays empty, columns of any name stay.
    """
    field = toxic_crf.fit(docs, table(spark, sf_dir, "labels"))
    score = toxic_crf.scorer(spark, field)(F.col("text").cast("string"))["score"]
    return docs.where(score < THRESHOLD)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, of those with the smallest id any text.

    Judged by texts alone, whole; ids may repeat or be NULL. Documents without words and an empty
    table stay as they are, as do columns of any name.
    """
    return one_of_each(docs, WORDS, PERCENT)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Whole texts are searched; NULL and empty ones hold nothing and stay, as do repeated rows, NULL ids,
    an empty table and columns of any name.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret.

    Whole texts are scanned, equal ones once; NULL and empty texts, repeated rows, NULL ids, an empty table
    and columns of any name stay as they are.
    """
    return secret_ledger.redact(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of all documents.

    Whole texts are encoded; a NULL text counts as empty, repeated rows and NULL ids stay, other columns
    go; an empty table gives an empty result.
    """
    return chunk_bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmarks),
    ("secrets", without_secrets),
    ("bpe", as_tokens),
]

# Models, byte-pair encoding and components of a graph can't be put into SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
