"""Source column types to Spark types, and declared table shapes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import timestamp

# Fixed values: (text contained in the source type, Spark type), first match wins.
TYPE_RULES = [
    ("[]", T.StringType()),
    ("array", T.StringType()),
    ("interval", T.StringType()),
    ("point", T.StringType()),
    ("char", T.StringType()),
    ("text", T.StringType()),
    ("bigint", T.LongType()),
    ("smallint", T.ShortType()),
    ("int", T.IntegerType()),
    ("decimal", T.DecimalType(38, 18)),
    ("numeric", T.DecimalType(38, 18)),
    ("float", T.DoubleType()),
    ("double", T.DoubleType()),
    ("real", T.FloatType()),
    ("timestamp with time zone", T.TimestampType()),
    ("timestamptz", T.TimestampType()),
    ("timestamp", T.TimestampNTZType()),
    ("date", T.DateType()),
    ("time", T.StringType()),
    ("bool", T.BooleanType()),
    ("json", T.StringType()),
    ("uuid", T.StringType()),
]


def target_type(
    source_type: str, precision: int | None = None, scale: int | None = None
) -> T.DataType:
    """The Spark type for a source type name; unknown types are text."""
    name = source_type.lower()
    for part, dtype in TYPE_RULES:
        if part in name:
            if isinstance(dtype, T.DecimalType) and precision:
                return T.DecimalType(precision, scale or 0)
            return dtype
    return T.StringType()


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a target, as a source's column catalog describes it."""

    name: str
    type: str
    nullable: bool = True
    default: str | None = None
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        return target_type(self.type, self.precision, self.scale)

    @property
    def length_limit(self) -> int | None:
        limited = isinstance(self.spark_type, T.StringType) and self.max_length
        return self.max_length if limited else None


def shape_of(schema: T.StructType) -> list[ColumnSpec]:
    """The declared shape of an existing table."""
    out = []
    for f in schema.fields:
        d = f.dataType
        numbers = (d.precision, d.scale) if isinstance(d, T.DecimalType) else (None, None)
        names = {
            T.LongType: "bigint",
            T.ShortType: "smallint",
            T.IntegerType: "integer",
            T.DoubleType: "double precision",
            T.FloatType: "real",
            T.DecimalType: "numeric",
            T.DateType: "date",
            T.TimestampNTZType: "timestamp",
            T.TimestampType: "timestamp with time zone",
            T.BooleanType: "boolean",
        }
        out.append(ColumnSpec(f.name, names.get(type(d), "text"), f.nullable, None, None, *numbers))
    return out


def struct_of(shape: Sequence[ColumnSpec]) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type, c.nullable) for c in shape])


def default_value(spec: ColumnSpec, run_ts: object) -> Column:
    """A declared default as a literal when it is safe to evaluate here, else NULL.

    Safe: the current time (taken from ``run_ts``), true/false, numbers, quoted text.
    Sequence and cast expressions belong to the source database and give NULL.
    """
    dtype, text = spec.spark_type, (spec.default or "").strip()
    lowered = text.lower()
    if not text or "nextval" in lowered or "::" in text:
        return F.lit(None).cast(dtype)
    if lowered.startswith(("now(", "current_timestamp")):
        return timestamp(run_ts).cast(dtype)
    quoted = re.fullmatch(r"'((?:[^']|'')*)'", text)
    if quoted:
        return F.lit(quoted.group(1).replace("''", "'")).cast(dtype)
    if lowered in ("true", "false") or re.fullmatch(r"[+-]?\d+(\.\d+)?", text):
        return F.lit(text).cast(dtype)
    return F.lit(None).cast(dtype)
