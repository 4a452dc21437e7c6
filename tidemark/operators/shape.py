"""Shape and type operators: casting, conforming, aligning, drift and profile reports.

Reports are one aggregation over all columns, then one row per column. A wide table is
still read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean as rules
from tidemark.functions.casts import cast_column
from tidemark.functions.names import col, cols, quote
from tidemark.functions.types import ColumnSpec, default_value, struct_of


def unpivot_counts(
    row: DataFrame, columns: Sequence[str], measures: Sequence[str], label: str = "column_name"
) -> DataFrame:
    """One aggregate row with columns ``<i>_<measure>`` into one row per named column."""
    entries = [
        F.struct(
            F.lit(name).alias(label),
            *(F.col(f"`{i}_{m}`").alias(m) for m in measures),
        )
        for i, name in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def _cast(c: Column, source: T.DataType, spec: ColumnSpec) -> Column:
    value = cast_column(c, source, spec.spark_type)
    if spec.length_limit:
        value = F.when(F.length(value) <= spec.length_limit, value)
    return value


def cast_to(df: DataFrame, shape: Sequence[ColumnSpec]) -> DataFrame:
    """Cast the columns that ``shape`` names; a value that does not fit becomes NULL.

    One projection that never fails a job; :func:`drift_report` counts what was lost.
    """
    specs = {s.name: s for s in shape}
    return df.select(
        *(
            _cast(col(f.name), f.dataType, specs[f.name]).alias(f.name)
            if f.name in specs
            else col(f.name)
            for f in df.schema.fields
        )
    )


def conform(df: DataFrame, shape: Sequence[ColumnSpec], run_ts: object = None) -> DataFrame:
    """Rows in exactly the target's shape: its columns in its order, cast, and missing
    columns filled with the declared default where that is safe, else NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def value(s: ColumnSpec) -> Column:
        if s.name in have:
            return _cast(col(s.name), have[s.name], s)
        return default_value(s, run_ts)

    return df.select(*(value(s).alias(s.name) for s in shape))


def lost_values(df: DataFrame, shape: Sequence[ColumnSpec]) -> list[Column]:
    """Aggregates by column name: how many values :func:`conform` would turn into NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.count_if(col(s.name).isNotNull() & _cast(col(s.name), have[s.name], s).isNull()).alias(s.name)
        for s in shape
        if s.name in have
    ]


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*(col(c).cast("string").alias(c) for c in df.columns))


def align(df: DataFrame, like: Sequence[str] | T.StructType) -> DataFrame:
    """Columns in the target's order: given names, the shared ones only; given a schema,
    missing ones are added as NULL."""
    have = set(df.columns)
    if isinstance(like, T.StructType):
        return df.select(
            *(
                col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                for f in like.fields
            )
        )
    return df.select(*(col(c) for c in like if c in have))


def drift_report(df: DataFrame, shape: Sequence[ColumnSpec]) -> DataFrame:
    """Per target column: types on both sides, rows, and what does not fit.

    ``cast_failures`` values the target type cannot hold, ``over_long`` texts beyond the
    length limit, ``nulls_in_not_null`` NULLs where the target forbids them. A column the
    source lacks has type ``missing`` and counts every row as NULL.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[Column] = []
    entries: list[Column] = []
    for i, s in enumerate(shape):
        present = s.name in have
        c = col(s.name) if present else F.lit(None).cast(s.spark_type)
        value = cast_column(c, have[s.name], s.spark_type) if present else c
        too_long = F.length(value) > s.length_limit if s.length_limit else F.lit(False)
        forbidden = F.lit(False) if s.nullable else c.isNull()
        counts = {
            "row_count": F.count(F.lit(1)),
            "cast_failures": F.count_if(c.isNotNull() & value.isNull()),
            "over_long": F.count_if(too_long),
            "nulls_in_not_null": F.count_if(forbidden),
        }
        aggs += [count.alias(f"{i}_{name}") for name, count in counts.items()]
        entries.append(
            F.struct(
                F.lit(s.name).alias("column_name"),
                F.lit(have[s.name].simpleString() if present else "missing").alias("source_type"),
                F.lit(s.spark_type.simpleString()).alias("target_type"),
                *(F.col(f"`{i}_{name}`").alias(name) for name in counts),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def profile(df: DataFrame, exact: bool = False, rsd: float = 0.02) -> DataFrame:
    """Per column: rows, NULLs, distinct values, lowest and highest value as text.

    Distinct counts are HyperLogLog estimates (``rsd`` relative error), all from one scan.
    ``exact`` counts values instead, all columns in one further scan and shuffle of (column, value
    as text), with partial counts so that a frequent value is no hot spot. Columns that are no single
    values are grouped one by one.
    """
    exactly = _exact_distinct(df) if exact else None
    aggs: list[Column] = []
    for i, name in enumerate(df.columns):
        c = col(name)
        aggs += [
            F.count(F.lit(1)).alias(f"{i}_row_count"),
            F.count_if(c.isNull()).alias(f"{i}_null_count"),
            *([] if exact else [F.approx_count_distinct(c, rsd).alias(f"{i}_distinct_count")]),
            F.min(c).cast("string").alias(f"{i}_min_value"),
            F.max(c).cast("string").alias(f"{i}_max_value"),
        ]
    measures = ["row_count", "null_count", "distinct_count", "min_value", "max_value"]
    if not exact:
        return unpivot_counts(df.agg(*aggs), df.columns, measures)
    rest = unpivot_counts(df.agg(*aggs), df.columns, [m for m in measures if m != "distinct_count"])
    # A row per column on either side.
    return rest.join(F.broadcast(exactly), "column_name", "left").select(
        "column_name",
        *(F.coalesce(m, F.lit(0)).alias(m) if m == "distinct_count" else F.col(m) for m in measures),
    )


def _exact_distinct(df: DataFrame) -> DataFrame:
    """``(column_name, distinct_count)`` of the columns that hold values."""
    single, parts = [], []
    for f in df.schema.fields:
        c, name = col(f.name), F.lit(f.name).alias("column_name")
        if isinstance(f.dataType, T.AtomicType):
            # The two zeros are one value, but two texts.
            zero = isinstance(f.dataType, (T.FloatType, T.DoubleType))
            text = (c + F.lit(0.0).cast(f.dataType) if zero else c).cast("string")
            single.append(F.struct(name, text.alias("v")))
        elif not isinstance(f.dataType, T.NullType):
            parts.append(df.where(c.isNotNull()).select(name, c.alias("v")).distinct())
    if single:
        values = df.select(F.inline(F.array(*single))).where("v IS NOT NULL")
        parts.insert(0, values.distinct())
    if not parts:
        return df.limit(0).select(F.lit("").alias("column_name"), F.lit(0).cast("long").alias("distinct_count"))
    counts = [p.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")) for p in parts]
    return reduce(DataFrame.unionByName, counts)


def clean(df: DataFrame, schema: T.StructType | Sequence[ColumnSpec]) -> DataFrame:
    """Clean every text column by its declared type, in one projection.

    Columns that ``schema`` does not name, or that are not text, are untouched.
    """
    declared = schema if isinstance(schema, T.StructType) else struct_of(schema)
    types = {f.name: f.dataType for f in declared.fields}
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name in types and isinstance(f.dataType, T.StringType):
            c = rules.rule_for(types[f.name])(c).alias(f.name)
        out.append(c)
    return df.select(*out)


def clean_columns(df: DataFrame, columns: Sequence[str], rule) -> DataFrame:
    """Apply one cleaning rule to chosen columns."""
    return df.select(*(rule(col(c)).alias(c) if c in columns else col(c) for c in df.columns))


def post_clean_check(df: DataFrame, integer_columns: Sequence[str]) -> DataFrame:
    """What cleaning left behind: (column_name, check, n) for every text column.

    ``decimal_point`` in columns meant to be integers, ``blank`` in any.
    """
    aggs: list[Column] = []
    labels: list[tuple[str, str]] = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.StringType):
            continue
        c = col(f.name)
        if f.name in integer_columns:
            aggs.append(F.count_if(c.contains(".")))
            labels.append((f.name, "decimal_point"))
        aggs.append(F.count_if(rules.strip(c) == ""))
        labels.append((f.name, "blank"))
    row = df.agg(*(a.alias(f"{i}_n") for i, a in enumerate(aggs)))
    return row.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.lit(check).alias("check"),
                        F.col(f"`{i}_n`").alias("n"),
                    )
                    for i, (name, check) in enumerate(labels)
                )
            )
        )
    )


def not_null_violations(
    df: DataFrame, columns: Sequence[str], sample_by: Sequence[str], samples: int = 3
) -> DataFrame:
    """Per NOT NULL column that holds NULLs: how many, and the first few rows as JSON.

    Samples are the first rows in ``sample_by`` order. One scan finds them for all columns,
    and each task passes on at most ``samples`` rows per column.
    """
    counts = df.agg(
        *(F.count_if(col(c).isNull()).alias(f"{i}_null_count") for i, c in enumerate(columns))
    )
    report = unpivot_counts(counts, columns, ["null_count"]).where("null_count > 0")
    lacking = F.array_compact(F.array(*(F.when(col(c).isNull(), F.lit(c)) for c in columns)))
    order = [*sample_by, *(c for c in df.columns if c not in sample_by)]
    w = Window.partitionBy("column_name").orderBy(*(F.col("row")[c] for c in order))
    first = (
        df.select(F.explode(lacking).alias("column_name"), F.struct(*cols(df.columns)).alias("row"))
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= samples)
    )
    row = F.to_json("row", {"ignoreNullFields": "false"})
    ranked = F.sort_array(F.collect_list(F.struct("rank", row.alias("sample"))))
    # At most ``samples`` short texts per column.
    found = first.groupBy("column_name").agg(ranked.getField("sample").alias("samples"))
    return report.join(F.broadcast(found), "column_name", "left")


def fill_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs of NOT NULL text columns with empty text; other types are left alone."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.fillna("", subset=[quote(c) if "." in c else c for c in columns if c in text])


def quality_report(df: DataFrame, shape: Sequence[ColumnSpec]) -> DataFrame:
    """Findings per column: NULLs are a warning, a decimal point in an integer an error."""
    aggs: list[Column] = []
    entries: list[Column] = []
    for i, s in enumerate(shape):
        c = col(s.name)
        checks = [("null_values", "warning", F.count_if(c.isNull()))]
        if isinstance(s.spark_type, T.IntegralType):
            pointed = F.count_if(c.cast("string").contains("."))
            checks.append(("decimal_in_integer", "error", pointed))
        for check, status, count in checks:
            aggs.append(count.alias(f"{i}_{check}"))
            entries.append(
                F.struct(
                    F.lit(s.name).alias("column_name"),
                    F.lit(check).alias("check"),
                    F.lit(status).alias("status"),
                    F.col(f"`{i}_{check}`").alias("n"),
                )
            )
    return df.agg(*aggs).select(F.inline(F.array(*entries))).where("n > 0")
