"""Casts of dirty text that stay cheap when many values do not fit.

A failing ``try_cast`` raises and catches an exception per value, which is far slower than
a pattern match. Each cast from text is guarded by a pattern that lets everything through
that the cast could accept, so the result is the same.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = r"^[^0-9A-Za-z.]*[0-9]+[^0-9A-Za-z.]*$"
NUMBER = r"^[^0-9A-Za-z]*[0-9][^A-Za-z]*([eE][+-]?[0-9]+)?[dDfF]?[^0-9A-Za-z]*$"
NOT_FINITE = r"(?i)^[^0-9a-z]*(inf|infinity|nan)[^0-9a-z]*$"
TRUTH = r"(?i)^[^0-9a-z]*(t|true|y|yes|1|f|false|n|no|0)[^0-9a-z]*$"


def could_be(c: Column, dtype: T.DataType) -> Column | None:
    """A cheap necessary condition for text to cast to ``dtype``; None when there is none."""
    if isinstance(dtype, T.IntegralType):
        return c.rlike(WHOLE)
    if isinstance(dtype, T.DecimalType):
        return c.rlike(NUMBER)
    if isinstance(dtype, T.FractionalType):
        return c.rlike(NUMBER) | c.rlike(NOT_FINITE)
    if isinstance(dtype, T.BooleanType):
        return c.rlike(TRUTH)
    return None


def cast_text(c: Column, dtype: T.DataType) -> Column:
    """Text to ``dtype``; NULL where it does not fit."""
    guard = could_be(c, dtype)
    value = c.try_cast(dtype)
    return value if guard is None else F.when(guard, value)


def cast_column(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """A column of type ``source`` to ``target``; NULL where a value does not fit."""
    if source == target:
        return c
    return cast_text(c, target) if isinstance(source, T.StringType) else c.try_cast(target)


def date_guard(c: Column, fmt: str) -> Column | None:
    """A necessary condition for text in a purely numeric date format."""
    if re.search(r"[A-Za-z]", re.sub(r"y{4}|MM|dd|HH|mm|ss", "", fmt)):
        return None
    pattern = re.sub(
        r"y{4}|MM|dd|HH|mm|ss|[^A-Za-z]",
        lambda m: f"[0-9]{{{len(m[0])}}}" if m[0][0].isalpha() else re.escape(m[0]),
        fmt,
    )
    return c.rlike(f"^{pattern}$")
