"""JSON documents in a text column: what is in them, by path, and typed columns out of them.

Documents are parsed once into Spark's VARIANT; paths, kinds and casts work on that, in the JVM, in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import col, cols
from tidemark.operators.shape import unpivot_counts

# Kinds of values, as reports name them, by the type Spark finds.
KINDS = {
    "OBJECT": "object", "ARRAY": "array", "STRING": "string", "BIGINT": "integer", "DOUBLE": "decimal",
    "FLOAT": "decimal", "DECIMAL": "decimal", "BOOLEAN": "boolean", "VOID": "null",
}
INVALID, ABSENT = "invalid", "absent"
DEPTH = 8


def kind_of(v: Column) -> Column:
    """The kind of a VARIANT value; a number without a fraction is an integer however long it is."""
    whole = F.regexp_replace(F.schema_of_variant(v), r"^DECIMAL\(\d+,\s*0\)$", "BIGINT")
    names = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    # Of OBJECT<...>, ARRAY<...> and DECIMAL(...) the first word; dates and the like keep their names.
    return F.transform(
        F.array(F.split(whole, "[(<]")[0]), lambda name: F.coalesce(F.try_element_at(names, name), F.lower(name))
    )[0]


def _step(path: Column, key: Column) -> Column:
    """The path of an object's member; names that are no plain words are quoted."""
    plain = key.rlike("^[A-Za-z_][A-Za-z_0-9]*$")
    quoted = F.concat(F.lit('["'), F.regexp_replace(key, r'(["\\])', r"\\$1"), F.lit('"]'))
    return F.concat(path, F.when(plain, F.concat(F.lit("."), key)).otherwise(quoted))


def _children(node: Column) -> Column:
    """Members of an object or elements of an array as (path, value); nothing for other values.

    All elements of an array share one path, ``[*]``.
    """
    members = F.map_entries(F.try_variant_get(node["v"], "$", "map<string,variant>"))
    elements = F.try_variant_get(node["v"], "$", "array<variant>")
    none = F.array().cast("array<struct<path:string,v:variant>>")
    return F.concat(
        F.coalesce(
            F.transform(members, lambda e: F.struct(_step(node["path"], e["key"]).alias("path"), e["value"].alias("v"))),
            none,
        ),
        F.coalesce(
            F.transform(elements, lambda x: F.struct(F.concat(node["path"], F.lit("[*]")).alias("path"), x.alias("v"))),
            none,
        ),
    )


def json_paths(df: DataFrame, column: str, depth: int = DEPTH) -> DataFrame:
    """``(path, kind, values, documents)``: how often each kind of value stands at each path.

    ``documents`` counts documents that have the kind there at least once. A text that is no JSON counts as ``invalid``
    at path ``$``, NULL as ``absent``. Values nested deeper than ``depth`` are counted as the object or array that holds them. One scan; counts
    are combined before the shuffle, so a frequent path is no hot spot.
    """
    text = col(column)
    # One column per level, each the children of all nodes of the level before: computed once each.
    rows = df.select(text.isNull().alias("absent"), F.try_parse_json(text).alias("v")).withColumn(
        "l0", F.array(F.struct(F.lit("$").alias("path"), F.col("v")))
    )
    for k in range(1, depth):
        rows = rows.withColumn(f"l{k}", F.flatten(F.transform(f"l{k - 1}", _children)))

    def named(node: Column) -> Column:
        return F.struct(node["path"].alias("path"), kind_of(node["v"]).alias("kind"))

    parsed = F.concat(*[F.transform(f"l{k}", named) for k in range(depth)])
    why = F.when(F.col("absent"), F.lit(ABSENT)).otherwise(F.lit(INVALID))
    failed = F.array(F.struct(F.lit("$").alias("path"), why.alias("kind")))
    # Equal entries of a document as one, with their number.
    per_document = rows.select(F.when(F.col("v").isNull(), failed).otherwise(parsed).alias("all")).select(
        F.explode(F.transform(F.array_distinct("all"), lambda d: F.struct(
            d["path"].alias("path"), d["kind"].alias("kind"), F.size(F.filter("all", lambda e: e == d)).alias("n")
        ))).alias("e")
    )
    return per_document.groupBy("e.path", "e.kind").agg(
        F.sum("e.n").alias("values"), F.count(F.lit(1)).alias("documents")
    )


def json_drift(paths: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """What :func:`json_paths` found against ``declared`` kinds by path.

    ``(path, declared, found, fitting, other)``: ``found`` lists the kinds that stand there, ``other`` counts values of other kinds
    than declared; NULLs inside documents fit any kind, integers fit ``decimal``. Paths that aren't
    declared have ``declared`` NULL, and all their values are ``other``; declared ones that never occur count 0.
    """
    spark = paths.sparkSession
    want = spark.createDataFrame(list(declared.items()), "path string, declared string")
    fits = (
        (F.col("kind") == F.col("declared"))
        | (F.col("kind") == "null")
        | ((F.col("kind") == "integer") & (F.col("declared") == "decimal"))
    )
    fits = F.col("declared").isNotNull() & F.coalesce(fits, F.lit(False))
    # A row per path and kind: as few as the documents have shapes.
    return paths.join(want, "path", "full").groupBy("path", "declared").agg(
        F.array_sort(F.collect_set("kind")).alias("found"),
        F.coalesce(F.sum(F.when(fits, F.col("values"))), F.lit(0)).alias("fitting"),
        F.coalesce(F.sum(F.when(~fits, F.col("values"))), F.lit(0)).alias("other"),
    )


def _picked(column: str, shape: Mapping[str, tuple[str, str]]) -> list[tuple[str, Column, Column]]:
    """(name, typed value, does a value stand there that the type can't hold)."""
    v = F.try_parse_json(col(column))
    out = []
    for name, (path, dtype) in shape.items():
        raw, value = F.try_variant_get(v, path, "variant"), F.try_variant_get(v, path, dtype)
        there = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(False))
        out.append((name, value, F.coalesce(there & value.isNull(), F.lit(False))))
    return out


def json_columns(df: DataFrame, column: str, shape: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a typed column per entry of ``shape``: name -> (path, type).

    A path that a document lacks, a NULL there, a value that the type can't hold and a text that is no
    JSON give NULL; :func:`json_column_report` counts them apart. Types may be nested (``array<int>``); an element
    that doesn't fit is NULL in its array. New names must not clash.
    """
    clash = [n for n in shape if n in df.columns]
    if clash:
        raise ValueError(f"columns {clash} exist already")
    return df.select(*cols(df.columns), *(value.alias(name) for name, value, _ in _picked(column, shape)))


def json_column_report(df: DataFrame, column: str, shape: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per typed column ``(column_name, row_count, filled, cast_failures)`` of :func:`json_columns`."""
    aggs = []
    picked = _picked(column, shape)
    for i, (_, value, failed) in enumerate(picked):
        aggs += [
            F.count(F.lit(1)).alias(f"{i}_row_count"),
            F.count(value).alias(f"{i}_filled"),
            F.count_if(failed).alias(f"{i}_cast_failures"),
        ]
    return unpivot_counts(df.agg(*aggs), [name for name, _, _ in picked], ["row_count", "filled", "cast_failures"])
