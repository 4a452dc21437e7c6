"""One document of each group of near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.multi_prefix_join import near_duplicates


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates: of those with the smallest id (NULL last) any text.

    Rows are judged by their texts alone: an id that repeats names as many documents as it has texts, and
    rows without an id are documents like others. Rows that only repeat an id and its text
    are one. Documents without words (NULL, empty) resemble nothing and are all kept. Texts of any
    length are compared whole; columns of any name stay; an empty table stays empty.
    """
    # Rows of one id and one text have one name of 64 bits, as the join asks for. Texts that share a
    # name by accident are told apart below, so that none is lost.
    name = F.xxhash64("doc_id", F.col("text").cast("string"))
    has_words = F.coalesce(F.col("text").cast("string").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    worded = docs.where(has_words)
    found = near_duplicates(worded.select(name.alias("doc_id"), "text"), words, percent)
    first = (
        found.select(F.col("doc_id").alias("name"), "component_id")
        .distinct()
        .join(worded.select(name.alias("name"), "doc_id").distinct(), "name")
        .groupBy("component_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "name")).alias("least"))
        .select("least.name")
    )
    # Rows of one name may differ in other columns.
    others = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    one = (
        worded.select(
            name.alias("name"), F.sha2(F.col("text").cast("string"), 256).alias("own"),
            F.struct(*docs.columns).alias("r"), others.alias("others"),
        )
        .join(first, "name", "left_semi")
        .groupBy("name", "own")
        .agg(F.min_by("r", "others").alias("r"))
        .select("r.*")
    )
    return one.unionByName(docs.where(~has_words))
