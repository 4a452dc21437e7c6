"""Typed literals that stay foldable, so that filters on them reach the file scan."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(value: Any, dtype: T.DataType | str) -> Column:
    """``value`` as a literal of ``dtype``.

    Dates and times travel as text and are cast: a plain ``lit(datetime)`` is a
    zoned timestamp, and comparing it with a zone-less column would wrap the column
    in a cast and lose the pushdown.
    """
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast(dtype)


def timestamp(value: Any) -> Column:
    """A zone-less timestamp literal from a datetime or ISO text; columns pass through."""
    if isinstance(value, Column):
        return value
    return typed(value, "timestamp_ntz")
