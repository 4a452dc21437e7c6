"""What to sync, as plain validated data."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from tidemark.functions.names import as_list, check_identifier
from tidemark.functions.types import ColumnSpec

# The sync modes and incremental field types a configuration may name.
MODES = (
    "full_copy",
    "full_sync",
    "incremental_sync",
    "incremental",
    "delete_insert",
    "insert_ignore",
    "cdc",
    "version_sync",
)
FIELD_KINDS = ("yyyymmdd", "date", "timestamp", "datetime", "integer", "default")
DUPLICATE_POLICIES = ("error", "latest", "keep", "unique")


@dataclass(frozen=True)
class TargetSpec:
    """One of several targets of a fan-out: its own mode, filter, keys and duplicate policy."""

    name: str
    mode: str = "full_copy"
    where: str | None = None
    keys: tuple[str, ...] = ()
    on_duplicate: str = "error"
    order_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(as_list(self.keys)))
        object.__setattr__(self, "order_by", tuple(as_list(self.order_by)))
        check_identifier(self.name)
        if self.on_duplicate not in DUPLICATE_POLICIES:
            raise ValueError(f"unknown duplicate policy: {self.on_duplicate!r}")
        if self.mode not in MODES:
            raise ValueError(f"unknown sync mode: {self.mode!r}")


@dataclass(frozen=True)
class SyncSpec:
    """How one source table is brought into one target table.

    ``source`` is anything :func:`tidemark.sources.scan.scan` reads. ``where`` replaces
    the incremental filter unless ``combine="and"``; ``lag`` moves the high-water mark back
    for late rows. For ``version_sync`` ``incremental_field`` is the row version, and
    ``where`` holds in addition; with a ``version_range_limit``, for sources whose versions wrap
    around, a range that reaches it makes the sync look at every row, deleting none.
    ``on_duplicate`` says what to do
    with a key that is staged twice; ``latest`` needs ``order_by``. With ``buckets`` the
    target is split by key and a merge rewrites only the buckets it touches. With ``shape``
    the extract is cleaned by declared type and brought into that shape; values that do not fit
    fail the sync, or become NULL and are counted with ``on_bad_value="null"``. ``check_keys``
    compares staged with target keys after the write.
    """

    target: str
    source: Any
    keys: tuple[str, ...]
    mode: str = "full_sync"
    incremental_field: str | None = None
    incremental_type: str = "default"
    where: str | None = None
    combine: str = "exclusive"
    lag: str | int | None = None
    version_range_limit: int | None = None
    on_duplicate: str = "error"
    order_by: tuple[str, ...] = ()
    buckets: int | None = None
    shape: tuple[ColumnSpec, ...] = ()
    on_bad_value: str = "error"
    check_keys: bool = False
    enabled: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(as_list(self.keys)))
        object.__setattr__(self, "order_by", tuple(as_list(self.order_by)))
        object.__setattr__(self, "shape", tuple(self.shape))
        check_identifier(self.target)
        for name in self.keys:
            check_identifier(name)
        if self.mode not in MODES:
            raise ValueError(f"unknown sync mode: {self.mode!r}")
        if self.mode != "full_copy" and not self.keys:
            raise ValueError(f"{self.mode} needs at least one key column")
        beyond = ("incremental_sync", "incremental", "version_sync")
        if self.mode in beyond and not self.incremental_field:
            raise ValueError(f"{self.mode} needs incremental_field")
        if self.incremental_field:
            check_identifier(self.incremental_field)
        if self.incremental_type not in FIELD_KINDS:
            raise ValueError(f"unknown incremental type: {self.incremental_type!r}")
        if self.combine not in ("exclusive", "and"):
            raise ValueError(f"combine must be 'exclusive' or 'and', not {self.combine!r}")
        if self.on_duplicate not in DUPLICATE_POLICIES:
            raise ValueError(f"unknown duplicate policy: {self.on_duplicate!r}")
        if self.buckets is not None and (self.buckets < 1 or not self.keys):
            raise ValueError("buckets must be at least 1 and needs key columns")
        if self.on_bad_value not in ("error", "null"):
            raise ValueError(f"unknown policy for bad values: {self.on_bad_value!r}")
        if self.check_keys and not self.keys:
            raise ValueError("check_keys needs key columns")
        if self.on_duplicate == "latest" and not self.order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
