"""The registered queries of this package, one per operator, and their SQL twins where SQL can ask."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chunk_bpe import digests
from tidemark.llm.column_bwt import repeated_strings
from tidemark.llm.common import table
from tidemark.llm.cross_parsing import languages, train
from tidemark.llm.decontaminate import leaks
from tidemark.llm.match_packing import pack, pieces
from tidemark.llm.merkle_layout import audited
from tidemark.llm.multi_prefix_join import near_duplicates
from tidemark.llm.rotation_codes import near_vectors
from tidemark.llm.secret_ledger import RULES, scanned, secrets
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.toxic_crf import fit, toxicity
from tidemark.llm.weak_labels import fit as fit_quality
from tidemark.llm.weak_labels import quality
from tidemark.llm.whitening import components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op3_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


@query
def op6_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = fit(docs, labels.where(fold("doc_id", 3) != 1))
    return toxicity(docs, field).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted", "spans"
    )


@query
def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier state of the history is scanned first, then all of it with the ledger that left:
    contents of the first scan are not scanned again."""
    docs = table(spark, sf_dir, "documents")
    ledger = scanned(docs.where(fold("doc_id", 2) == 0))
    return secrets(docs, ledger)


def _spans_sql() -> str:
    """Every rule's matches by lengths of what lies between them, as the operator defines them."""
    parts = []
    for place, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, '{r.name}' AS kind, {place} AS place, {r.at_least} AS need,
  string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS whole,
  regexp_extract_all(t, '{pattern}', {r.group}) AS part
FROM d WHERE regexp_matches(t, '{r.hint.replace("'", "''")}')"""
        )
    return " UNION ALL ".join(parts)


ORACLES["op7_secret_ledger"] = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_spans_sql()}),
e AS (SELECT doc_id, kind, place, need, i, length(gaps[i]) AS gap, length(whole[i]) AS size,
  length(part[i]) AS counted
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m)),
p AS (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
s AS (SELECT doc_id, kind, place, (stop - size)::BIGINT AS start, stop::BIGINT AS stop
  FROM p WHERE counted >= need),
g AS (SELECT doc_id,
  count(*) FILTER (WHERE kind = 'assign') AS n_assign,
  count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)
    FILTER (WHERE place < 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""


@query
def op8_multi_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold("doc_id", 5) != 0))
    return languages(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"
    )


@query
def op9_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, *fit_quality(docs))


@query
def op10_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(table(spark, sf_dir, "documents")).drop("spans")


@query
def op11_match_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op12_merkle_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.when(fold("doc_id", 3) == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return audited(table(spark, sf_dir, "documents"), FIELDS, "lang", "doc_id", {"text": lowered})


def _leaf_sql(text: str) -> str:
    """A row's digest; the length of a field is that of its bytes."""
    fields = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
    return "sha256(" + " || ".join(
        f"coalesce(CAST(octet_length(encode({f})) AS VARCHAR) || ':' || {f}, '-')" for f in fields
    ) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves(g, i, h, n)``, and for every leaf its path to the root."""
    return f"""{name}_t AS (
  SELECT g, 0 AS level, i, h, n FROM {leaves}
  UNION ALL
  SELECT g, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM {name}_t
  WHERE n > 1 GROUP BY g, level, i // 8, n),
{name}_r AS (SELECT g, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM {name}_t WHERE n > 1 GROUP BY ALL)"""


# crc32 by its table of 256 remainders; trees level by level; a tampered leaf folded with the siblings it had.
ORACLES["op12_merkle_layout"] = f"""WITH RECURSIVE
steps AS (SELECT b AS start, 0 AS k, b AS c FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT start, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM steps WHERE k < 8),
remainders AS (SELECT list(c ORDER BY start) AS r FROM steps WHERE k = 8),
ids AS (SELECT doc_id, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda a, b: xor(a >> 8, r[(xor(a, b) & 255) + 1])), 4294967295) % 3 = 0 AS low
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), remainders),
d AS (SELECT doc_id, lang,
  {_leaf_sql("text")} AS h,
  CASE WHEN low THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql("text")} END AS found
  FROM documents LEFT JOIN ids USING (doc_id)),
e AS (SELECT *, coalesce('=' || lang, '-') AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
  count(*) OVER (PARTITION BY lang) AS n FROM d),
{_tree_sql("low", "e")},
subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n
  FROM low_t WHERE n = 1),
s AS (SELECT '' AS g, i, subroot AS h, n FROM subroots),
{_tree_sql("top", "s")},
p AS (
  SELECT g, i AS nth, 0 AS level, i, found AS f, '' AS proof FROM e
  UNION ALL
  SELECT p.g, nth, p.level + 1, p.i // 8,
    sha256(list_aggregate(list_concat(hs[:p.i % 8], [f], hs[p.i % 8 + 2:]), 'string_agg', '')),
    proof || coalesce(list_aggregate(list_concat(hs[:p.i % 8], hs[p.i % 8 + 2:]), 'string_agg', ''), '')
  FROM p JOIN low_r r ON r.g = p.g AND r.level = p.level AND r.run = p.i // 8),
low_end AS (SELECT g, nth, arg_max(f, level) AS f, arg_max(proof, level) AS proof FROM p GROUP BY ALL),
q AS (
  SELECT g, nth, 0 AS level, subroots.i, f, proof FROM low_end JOIN subroots USING (g)
  UNION ALL
  SELECT q.g, nth, q.level + 1, q.i // 8,
    sha256(list_aggregate(list_concat(hs[:q.i % 8], [f], hs[q.i % 8 + 2:]), 'string_agg', '')),
    proof || coalesce(list_aggregate(list_concat(hs[:q.i % 8], hs[q.i % 8 + 2:]), 'string_agg', ''), '')
  FROM q JOIN top_r r ON r.level = q.level AND r.run = q.i // 8),
ended AS (SELECT g, nth, arg_max(f, level) AS f, arg_max(proof, level) AS proof FROM q GROUP BY ALL),
root AS (SELECT h AS root FROM top_t WHERE n = 1)
SELECT doc_id, e.h AS leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root,
  f = root AS verified
FROM e JOIN ended ON ended.g = e.g AND ended.nth = e.i JOIN subroots ON subroots.g = e.g, root"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "embeddings"))
