"""CSV and NDJSON. Everything is read as text first and cleaned afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_list, cols

# How many rows an NDJSON export may ask for.
NDJSON_MIN, NDJSON_MAX = 1, 10_000

# Standard quoting (a quote is doubled), spaces kept, empty text and NULL both as nothing.
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, max_rows_per_file: int = 5_000_000) -> None:
    """Write CSV part files with a header each, bounded in rows so that reads stay parallel."""
    writer = df.write.mode("errorifexists").options(**CSV_OPTIONS)
    writer.option("maxRecordsPerFile", max_rows_per_file).csv(path)


def read_csv_text(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    file_columns: Sequence[str] | None = None,
    *,
    multi_line: bool,
) -> DataFrame:
    """Read CSV as text columns, in the order of ``columns``.

    ``file_columns`` is the order in the file, by default the same. Empty fields are NULL,
    a literal ``NA`` stays text. ``multi_line`` allows line breaks inside quotes, at the
    price of one task per file; without it large files are read split.
    """
    names = list(file_columns or columns)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    df = reader.option("multiLine", str(multi_line).lower()).option("enforceSchema", "false")
    return df.csv(path).select(*cols(columns))


def ndjson_line(df: DataFrame) -> Column:
    """The whole row as one JSON object: NULLs written, other alphabets kept as they are."""
    return F.to_json(F.struct(*cols(df.columns)), {"ignoreNullFields": "false"})


def to_ndjson(df: DataFrame, limit: int, order_by: str | Sequence[str] = ()) -> DataFrame:
    """The first ``limit`` rows as JSON text in column ``line``; :func:`write_ndjson` has all."""
    if not NDJSON_MIN <= limit <= NDJSON_MAX:
        raise ValueError(f"limit must be between {NDJSON_MIN} and {NDJSON_MAX}")
    ordered = df.orderBy(*cols(as_list(order_by))) if order_by else df
    return ordered.limit(limit).select(ndjson_line(df).alias("line"))


def write_ndjson(df: DataFrame, path: str) -> None:
    """All rows as NDJSON part files, NULLs written."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
