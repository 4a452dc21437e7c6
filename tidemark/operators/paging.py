"""Reading for people: search, sort, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import typed
from tidemark.functions.names import as_list, col, cols, require_columns

# Page sizes.
DEFAULT_SIZE, MAX_SIZE = 100, 1000


def search(df: DataFrame, column: str, term: str) -> DataFrame:
    """Rows whose text ``column`` contains ``term``, ignoring case.

    ``%`` and ``_`` in the term are wildcards. Only text columns can be searched.
    """
    require_columns(df.columns, [column], "search")
    if not isinstance(df.schema[column].dataType, T.StringType):
        raise TypeError(f"{column!r} is not a text column")
    return df.where(col(column).ilike(f"%{term}%"))


def _ordering(
    df: DataFrame, sort_by: str | None, order: str, key: str | Sequence[str] | None
) -> list[tuple[str, bool]]:
    """(column, ascending) in order of weight: the sort column, then the key as tie-break."""
    if order not in ("ASC", "DESC"):
        raise ValueError(f"order must be ASC or DESC, not {order!r}")
    keys = as_list(key) if key else []
    wanted = [(sort_by, order == "ASC")] if sort_by else []
    wanted += [(k, True) for k in keys if k != sort_by]
    require_columns(df.columns, [n for n, _ in wanted], "sort")
    return wanted


def _order_columns(ordering: Sequence[tuple[str, bool]]) -> list[Column]:
    return [
        col(n).asc_nulls_last() if ascending else col(n).desc_nulls_first()
        for n, ascending in ordering
    ]


def sort_page(
    df: DataFrame,
    sort_by: str | None = None,
    order: str = "ASC",
    key: str | Sequence[str] | None = None,
) -> DataFrame:
    """Sorted rows; NULLs come last ascending and first descending."""
    ordering = _ordering(df, sort_by, order, key)
    return df.orderBy(*_order_columns(ordering)) if ordering else df


def check_page(number: int, size: int) -> int:
    """The number of rows before the page."""
    if number < 1:
        raise ValueError("page numbers start at 1")
    if not 1 <= size <= MAX_SIZE:
        raise ValueError(f"page size must be between 1 and {MAX_SIZE}")
    return (number - 1) * size


def page(
    df: DataFrame,
    number: int = 1,
    size: int = DEFAULT_SIZE,
    sort_by: str | None = None,
    order: str = "ASC",
    key: str | Sequence[str] | None = None,
    unique_key: bool = False,
) -> DataFrame:
    """Page ``number`` of ``size`` rows.

    All pages of a table follow one total order: the sort column, the key, then every other
    column that has an order, unless the caller vouches for a ``unique_key``, which leaves no ties. So pages
    neither overlap nor miss rows, with or without a key; rows that differ in a map column only are
    taken as equal. The cost grows with the depth of the page; walk a table with :func:`keyset_page`.
    """
    if unique_key and not key:
        raise ValueError("unique_key needs a key")
    skip = check_page(number, size)
    ordering = _ordering(df, sort_by, order, key)
    named = {n for n, _ in ordering}
    if not unique_key:
        ordering += [(f.name, True) for f in df.schema.fields if f.name not in named and _has_order(f.dataType)]
    return df.orderBy(*_order_columns(ordering)).offset(skip).limit(size)


def _has_order(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_order(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_has_order(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def page_meta(df: DataFrame, size: int = DEFAULT_SIZE) -> DataFrame:
    """One row: ``total_count`` and ``total_pages`` (rounded up)."""
    check_page(1, size)
    total = df.agg(F.count(F.lit(1)).alias("total_count"))
    pages = F.call_function("div", F.col("total_count") + (size - 1), F.lit(size))
    return total.withColumn("total_pages", pages)


def keyset_page(
    df: DataFrame, key: str | Sequence[str], after: object = None, size: int = DEFAULT_SIZE
) -> DataFrame:
    """The next ``size`` rows by ``key`` after the last one seen.

    With several key columns ``after`` is a tuple of their last values. The filter on the
    first one reaches the file statistics, so the cost does not grow with the depth of the page
    as it does with an offset. Keys are unique and not NULL.
    """
    check_page(1, size)
    keys = as_list(key)
    require_columns(df.columns, keys, "keyset_page")
    if after is not None:
        last = list(after) if isinstance(after, (tuple, list)) else [after]
        if len(last) != len(keys):
            raise ValueError(f"after must name {len(keys)} values")
        edges = [typed(v, df.schema[k].dataType) for k, v in zip(keys, last, strict=True)]
        beyond = F.lit(False)
        for k, edge in zip(reversed(keys), reversed(edges), strict=True):
            beyond = (col(k) > edge) | ((col(k) == edge) & beyond)
        df = df.where((col(keys[0]) >= edges[0]) & beyond)
    return df.orderBy(*cols(keys)).limit(size)
