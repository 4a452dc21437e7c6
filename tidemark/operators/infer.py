"""Types and formats of text columns, found by looking at every value once.

Each value is tested against all candidates and becomes the set of those it fits. Sets are counted, not
values: a column has a handful of them, so counts are combined before the shuffle and what reaches the driver is a row
per column and set. Sets meet in a lattice: what all values of a column fit is its type; where no
single date format does, the formats that only some values fit also settle how the ambiguous ones are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean as rules
from tidemark.functions.names import col

# Candidates of plain types, most special first: what a value must look like.
PLAIN = {
    "boolean": r"^(?i:true|false|yes|no|on|off|t|f|y|n)$",
    "integer": r"^[+-]?[0-9]{1,18}$",
    "decimal": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$",
}
# Formats of dates and times and the look of their values; a value must also be a day that exists.
DATES = {
    "yyyyMMdd": r"^[0-9]{8}$",
    "yyyy-MM-dd": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "yyyy/MM/dd": r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$",
    "dd/MM/yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "MM/dd/yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    "dd.MM.yyyy": r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$",
    "dd-MM-yyyy": r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$",
}
TIMES = {
    "yyyy-MM-dd HH:mm:ss": r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$",
    "yyyyMMddHHmmss": r"^[0-9]{14}$",
    "dd/MM/yyyy HH:mm:ss": r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
    "MM/dd/yyyy HH:mm:ss": r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
}
# Eight digits are a date only within these years, else numbers of eight digits would all be days.
YEARS = (1900, 2100)


def _parsed(value: Column, fmt: str, looks: str) -> Column:
    """The time a value stands for in a format, NULL where it doesn't fit."""
    at = F.try_to_timestamp(F.when(value.rlike(looks), value), F.lit(fmt))
    return F.when(F.year(at).between(*YEARS), at) if fmt in ("yyyyMMdd", "yyyyMMddHHmmss") else at


def candidates(value: Column) -> Column:
    """The array of candidates that a text fits, most special first."""
    fits = [F.when(value.rlike(looks), F.lit(name)) for name, looks in PLAIN.items()]
    for fmt, looks in {**DATES, **TIMES}.items():
        fits.append(F.when(_parsed(value, fmt, looks).isNotNull(), F.lit(fmt)))
    return F.array_compact(F.array(*fits))


def format_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, candidates, n, example)``: how many values fit just these candidates.

    Text columns, by default all. Values are stripped first; NULL and tokens for it count under NULL candidates, texts that fit
    nothing under an empty array. ``example`` is the least value. One scan, no sample.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not columns:
        schema = "column_name string, candidates array<string>, n long, example string"
        return df.sparkSession.createDataFrame([], schema)
    cells = [F.struct(F.lit(c).alias("column_name"), rules.clean_null(rules.strip(col(c))).alias("v")) for c in columns]
    values = df.select(F.inline(F.array(*cells)))
    found = F.when(F.col("v").isNotNull(), candidates(F.col("v"))).alias("candidates")
    return values.select("column_name", found, "v").groupBy("column_name", "candidates").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("example")
    )


@dataclass(frozen=True)
class Inferred:
    """A column's type, and for dates and times the formats in the order they are to be tried.

    ``counts``: values by the format that reads them; ``ambiguous``: of these, values that another
    format of the list would read as another day; ``unread``: values no format of the list reads.
    """

    type: str
    formats: tuple[str, ...] = ()
    counts: Mapping[str, int] = field(default_factory=dict)
    ambiguous: int = 0
    unread: int = 0


def infer(counts: DataFrame, tolerance: float = 0.0) -> dict[str, Inferred]:
    """The type of each column out of :func:`format_counts`.

    The most special plain type that all values fit; else a date, or a time, if formats read all but
    a share of ``tolerance`` of them; else text. Formats are taken by how many values only they
    read, then by how many they read at all, so unmistakable values decide how ambiguous ones are read. A column
    without values is text.
    """
    sets: dict[str, list[tuple[tuple[str, ...], int]]] = {}
    for r in counts.collect():
        own = sets.setdefault(r["column_name"], [])
        if r["candidates"] is not None:
            own.append((tuple(r["candidates"]), r["n"]))
    return {name: _inferred(own, tolerance) for name, own in sets.items()}


def _inferred(sets: list[tuple[tuple[str, ...], int]], tolerance: float) -> Inferred:
    total = sum(n for _, n in sets)
    if not total:
        return Inferred("text")
    # Eight digits throughout are days rather than numbers, if each is one.
    common = set.intersection(*(set(s) for s, _ in sets))
    kinds = [("date", DATES), ("timestamp", {**DATES, **TIMES})]
    if not common & {"yyyyMMdd", "yyyyMMddHHmmss"}:
        for plain in PLAIN:
            if plain in common:
                return Inferred(plain, (), {plain: total})
    for kind, formats in kinds:
        read = sum(n for s, n in sets if set(s) & set(formats))
        if total - read <= tolerance * total:
            return _with_formats(kind, list(formats), sets, total - read)
    return Inferred("text", (), {"text": total})


def _with_formats(kind: str, formats: list[str], sets: list[tuple[tuple[str, ...], int]], unread: int) -> Inferred:
    left = [(set(s) & set(formats), n) for s, n in sets]
    left = [(s, n) for s, n in left if s]
    chosen: list[str] = []
    counts: dict[str, int] = {}
    while left:
        only = {f: sum(n for s, n in left if s == {f}) for f in formats}
        reads = {f: sum(n for s, n in left if f in s) for f in formats}
        best = max(formats, key=lambda f: (only[f], reads[f], -formats.index(f)))
        chosen.append(best)
        counts[best] = reads[best]
        left = [(s, n) for s, n in left if best not in s]
    both = sum(n for s, n in sets if len(set(s) & set(chosen)) > 1)
    return Inferred(kind, tuple(chosen), counts, both, unread)


SPARK_TYPES = {"boolean": "boolean", "integer": "bigint", "decimal": "double", "date": "date", "timestamp": "timestamp_ntz", "text": "string"}
TRUE = ["true", "yes", "on", "t", "y"]


def typed_column(c: Column, found: Inferred) -> Column:
    """A text column by its inferred type; what the type can't hold is NULL, as tokens for NULL are."""
    value = rules.clean_null(rules.strip(c))
    if found.type == "text":
        return c
    if found.type == "boolean":
        return F.when(value.rlike(PLAIN["boolean"]), F.lower(value).isin(TRUE))
    if found.type in PLAIN:
        return F.when(value.rlike(PLAIN[found.type]), value).try_cast(SPARK_TYPES[found.type])
    looks = {**DATES, **TIMES}
    read = F.coalesce(*[_parsed(value, f, looks[f]) for f in found.formats])
    return read.cast("timestamp_ntz").cast(SPARK_TYPES[found.type])


def typed(df: DataFrame, found: Mapping[str, Inferred]) -> DataFrame:
    """``df`` with the inferred columns typed, in one projection; other columns stay."""
    return df.select(*(typed_column(col(c), found[c]).alias(c) if c in found else col(c) for c in df.columns))
