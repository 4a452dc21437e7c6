"""Secret scans over the history of files, with a ledger of what was scanned already.

Every version of every file is addressed by the SHA-256 of its content (its blob). The ledger
holds one row per blob with the rules, each with its version, that were run over it and the
spans they found. A scan takes from the history the blobs with at least one
(blob, rule, rule version) that the ledger lacks, runs just those rules over just those blobs,
each content once however many paths and versions carry it, and joins findings back to all paths.

DataFrame functions only. A rule's spans come from cutting the text at its matches: what lies
between them and the matches themselves have known lengths, so running sums give positions
(code points, end exclusive).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``at_least`` characters.

    ``hint`` is a cheaper pattern that every text with a match has. A changed rule needs a new
    ``version``: the ledger goes by (name, version).
    """

    name: str
    version: int
    pattern: str
    group: int
    at_least: int
    hint: str


# The three base kinds, in their order.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12}"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32}"),
)
# Kinds this library adds; their spans stand beside the base ones.
ADDED_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, r"-----BEGIN [A-Z ]*PRIVATE KEY"),
    Rule("forge", 1, r"(?:gh[pousr]_|glpat-)[A-Za-z0-9_-]{20,}", 0, 0, r"gh[pousr]_|glpat-"),
    Rule("chat", 1, r"xox[abeprs]-[A-Za-z0-9-]{10,}", 0, 0, r"xox[abeprs]-"),
    Rule(
        "jwt",
        1,
        r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
        0,
        0,
        r"eyJ[A-Za-z0-9_-]{8}",
    ),
    Rule("url", 1, r"[a-z][a-z0-9+]{1,9}://[^\s/:@]{1,64}:[^\s/@]{3,}@", 0, 0, r"://[^\s/:@]{1,64}:"),
)
RULES = BASE_RULES + ADDED_RULES

SPAN = "struct<start: bigint, end: bigint>"
SCAN = f"struct<rule: string, version: int, spans: array<{SPAN}>>"
LEDGER = f"blob string, scans array<{SCAN}>"


STEP = "struct<gap: bigint, whole: bigint, size: bigint>"


def rule_steps(text: Column, rule: Rule) -> Column:
    """One rule's matches in ``text``, in order: characters since the last one, its length, and the
    length that counts."""
    pattern = F.lit(rule.pattern)

    def lengths(parts: Column) -> Column:
        return F.transform(parts, lambda x: F.length(x).cast("long"))

    between = lengths(F.split(text, rule.pattern, -1))
    whole = lengths(F.regexp_extract_all(text, pattern, 0))
    size = lengths(F.regexp_extract_all(text, pattern, rule.group))
    # Zipped, for an array named in a lambda function would be made again for each element. The
    # gap behind the last match has no match to go with.
    steps = F.zip_with(
        between,
        F.zip_with(whole, size, lambda w, s: F.struct(w.alias("whole"), s.alias("size"))),
        lambda gap, m: F.struct(gap.alias("gap"), m["whole"].alias("whole"), m["size"].alias("size")),
    )
    matches = F.filter(steps, lambda m: m["whole"].isNotNull())
    return F.when(text.rlike(rule.hint), matches).otherwise(F.array()).cast(f"array<{STEP}>")


def _tag(rule: Rule) -> str:
    return f"{rule.name}@{rule.version}"


def scan_new(history: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows ``(blob, scans)`` for what ``ledger`` lacks of ``history(blob, text)``.

    One row per blob with something new. Contents are gathered by blob before they are scanned,
    with the repeats of each task dropped before the shuffle. Append the rows to the ledger.
    """
    blobs = history.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        todo = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = ledger.select("blob", F.explode("scans").alias("s")).groupBy("blob").agg(
            F.collect_set(F.concat_ws("@", "s.rule", "s.version")).alias("seen")
        )
        every = F.array(*[F.lit(_tag(r)) for r in rules])
        todo = (
            blobs.join(seen, "blob", "left")
            .withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
            .where(F.size(F.array_except(every, F.col("seen"))) > 0)
        )
    steps = [
        F.when(
            ~F.array_contains("seen", _tag(r)),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                     rule_steps(F.col("text"), r).alias("steps")),
        )
        for r in rules
    ]
    # Written: lengths only, which the two readers below share.
    raw = saved(todo.select("blob", F.array_compact(F.array(*steps)).alias("scans")), "matches")
    # Where a match ends is a running sum, over rows: a text with any number of them costs as many steps.
    line = Window.partitionBy("blob", "rule", "version").orderBy("i")
    need = F.create_map(*[F.lit(x) for r in rules for x in (_tag(r), r.at_least)])
    found = (
        raw.select("blob", F.explode("scans").alias("s"))
        .select("blob", "s.rule", "s.version", F.posexplode("s.steps").alias("i", "m"))
        .withColumn("end", F.sum(F.col("m.gap") + F.col("m.whole")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("m.size") >= F.element_at(need, F.concat_ws("@", "rule", "version")))
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.collect_list(F.struct((F.col("end") - F.col("m.whole")).alias("start"), "end", "rule", "version"))
            ).alias("found")
        )
    )
    nothing = F.array().cast("array<struct<start: bigint, end: bigint, rule: string, version: int>>")
    every_scan = F.transform(
        "tags",
        lambda t: F.struct(
            t["rule"].alias("rule"),
            t["version"].alias("version"),
            F.transform(
                F.filter("found", lambda f: (f["rule"] == t["rule"]) & (f["version"] == t["version"])),
                lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end")),
            ).alias("spans"),
        ),
    )
    tags = F.transform("scans", lambda s: F.struct(s["rule"].alias("rule"), s["version"].alias("version")))
    return (
        raw.select("blob", tags.alias("tags"))
        .join(found, "blob", "left")
        .withColumn("found", F.coalesce("found", nothing))
        .select("blob", every_scan.cast(f"array<{SCAN}>").alias("scans"))
    )


def addressed(versions: DataFrame) -> DataFrame:
    """``versions(doc_id, text)`` with the blob of each text; a NULL text is the empty blob."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return versions.select("doc_id", text.alias("text")).withColumn("blob", F.sha2("text", 256))


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, found)`` for every row of ``versions(doc_id, blob)``.

    ``found`` is an array of (start, place of the kind, end, kind) in that order, from the scans of ``rules``
    in ``ledger``; a blob with several rows in it has its scans put together.
    """
    place = {r.name: i for i, r in enumerate(rules)}
    kinds = F.create_map(*[x for n, i in place.items() for x in (F.lit(n), F.lit(i))])
    wanted = F.array(*[F.lit(_tag(r)) for r in rules])
    spans = (
        ledger.where(F.exists("scans", lambda s: F.size(s["spans"]) > 0))
        .select("blob", F.explode("scans").alias("s"))
        .where(F.array_contains(wanted, F.concat_ws("@", "s.rule", "s.version")))
        .select("blob", "s.rule", F.explode("s.spans").alias("span"))
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("span.start").alias("start"),
                        F.get(F.map_values(kinds), F.array_position(F.map_keys(kinds), F.col("rule")).cast("int") - 1).alias("place"),
                        F.col("span.end").alias("end"),
                        F.col("rule").alias("kind"),
                    )
                )
            ).alias("found")
        )
    )
    empty = F.array().cast("array<struct<start: bigint, place: int, end: bigint, kind: string>>")
    return (
        versions.select("doc_id", "blob")
        .join(spans, "blob", "left")
        .select("doc_id", F.coalesce("found", empty).alias("found"))
    )


def listed(found: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` joined by commas, of all kinds or of some."""
    kept = found if kinds is None else F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def scanned(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger after a scan of ``docs(text)``: earlier rows and, written, those of what was new."""
    new = saved(scan_new(addressed(docs.select(F.lit(None).alias("doc_id"), "text")), ledger, rules), "ledger")
    return new if ledger is None else ledger.unionByName(new)


def secrets(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every row of ``docs(doc_id, text)``.

    A NULL text counts as empty: no spans, the hash of the empty string. Texts are scanned whole,
    in time that grows with their length and matches. Repeated rows stay repeated, a NULL ``doc_id``
    stays NULL, other columns are ignored. An empty table gives an empty result. ``ledger`` holds scans of
    earlier runs, which aren't repeated.
    """
    versions = addressed(docs)
    ledger_now = scanned(docs, ledger)
    base = tuple(r.name for r in BASE_RULES)

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return findings(versions, ledger_now).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(F.col("found"), base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]", ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping and touching spans become one mark.

    All columns stay as they are but ``text``, whatever their names; rows without findings are
    unchanged, NULL texts stay NULL. Rows go by content, so repeated and NULL ids need no care. Long texts
    are cut in time that grows with their length (a text's UTF-32 form must fit 2 GB). ``ledger`` as in :func:`secrets`.
    """
    spans = (
        scanned(docs, ledger)
        .select("blob", F.explode("scans").alias("s"))
        .where(F.array_contains(F.array(*[F.lit(_tag(r)) for r in RULES]), F.concat_ws("@", "s.rule", "s.version")))
        .select("blob", F.explode("s.spans").alias("x"))
        .select("blob", "x.start", "x.end")
    )
    before = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    # What is kept in front of each mark: from where the spans so far end to where the next one starts.
    kept = spans.withColumn("upto", F.max("end").over(before)).groupBy("blob").agg(
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("upto").isNull() | (F.col("start") > F.col("upto")),
                    F.struct(F.coalesce("upto", F.lit(0)).alias("low"), F.col("start").alias("high")),
                )
            )
        ).alias("kept"),
        F.max("end").alias("last"),
    )
    # The caller's columns travel as one, so that no name of his can meet one of these.
    text = F.col("row.text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = rows.withColumn("blob", F.sha2(F.coalesce(text, F.lit("")), 256)).join(kept, "blob", "left")
    def stretch(wide: Column, low: Column, high: Column) -> Column:
        return F.decode(F.substring(wide, (low * 4 + 1).cast("int"), ((high - low) * 4).cast("int")), "UTF-32")

    # Four bytes a character: a stretch is found without counting characters from the front. A lambda's
    # variable, so that a text is encoded once and not for each stretch.
    parts = F.transform(
        F.array(F.encode(text, "UTF-32")),
        lambda wide: F.concat(
            F.transform("kept", lambda k: stretch(wide, k["low"], k["high"])),
            F.array(stretch(wide, F.col("last"), F.octet_length(wide) / 4)),
        ),
    )[0]
    cut = F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(F.array_join(parts, mark))
    return found.select(
        *[(cut if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    )
