"""Identifiers: validation and quoting."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a valid identifier (Latin or Hangul first letter).
IDENTIFIER = r"^[a-zA-Z가-힣_][a-zA-Z0-9가-힣_$]*$"


def is_identifier(name: str) -> bool:
    return re.match(IDENTIFIER, name) is not None


def check_identifier(name: str) -> str:
    """Return ``name`` (each dot-separated part must be valid) or raise ValueError."""
    if not name or not all(is_identifier(part) for part in name.split(".")):
        raise ValueError(f"not a valid identifier: {name!r}")
    return name


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name: dots and Hangul letters need no care by the caller."""
    return F.col(quote(name))


def cols(names: Iterable[str]) -> list[str]:
    """Exact names in the form that select, groupBy, orderBy and struct take as text.

    Cheaper than a Column each, which costs several calls to the JVM.
    """
    return [quote(n) for n in names]


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def require_columns(available: Sequence[str], wanted: Iterable[str], what: str) -> None:
    missing = [n for n in wanted if n not in available]
    if missing:
        raise ValueError(f"{what}: no such column(s) {missing}; have {list(available)}")
