"""SCD-2 histories that persist: one run after another against a stored history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import col, cols
from tidemark.operators.history import HistoryColumns, snapshot
from tidemark.operators.stage import staged
from tidemark.sources.versions import VersionedTable, path_exists

RUN = "__run"


@dataclass(frozen=True)
class SnapshotTable:
    """A history below ``base``: open versions as a versioned table, closed ones by run.

    Closed versions never change: each run adds a folder with those it closed, and only the open
    ones are rewritten. A run becomes visible with the commit of its open versions; what a failed
    run left is overwritten by the next. A run is known by its ``run_ts`` and done once.
    """

    spark: SparkSession
    base: str
    key: str | Sequence[str]
    strategy: str = "check"
    check_cols: tuple[str, ...] | None = None
    updated_at: str | None = None
    hard_deletes: bool = False
    on_new_column: str = "error"
    names: HistoryColumns = field(default_factory=HistoryColumns)

    def __post_init__(self) -> None:
        if self.on_new_column not in ("error", "add", "drop"):
            raise ValueError(f"unknown policy for new columns: {self.on_new_column!r}")

    @property
    def open_versions(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.base}/open")

    def read(self) -> DataFrame:
        """The whole history as of the last run."""
        table = self.open_versions
        now = table.read()
        closed = f"{self.base}/closed"
        if not path_exists(self.spark, closed):
            return now
        old = self.spark.read.option("mergeSchema", "true").parquet(closed)
        old = old.where(F.col(RUN) <= table.version()).drop(RUN)
        return now.unionByName(old, allowMissingColumns=True).select(*cols(now.columns))

    def _with_columns_of(self, history: DataFrame, source: DataFrame) -> DataFrame:
        new = [f for f in source.schema.fields if f.name not in history.columns]
        if new and self.on_new_column == "error":
            raise ValueError(f"the history lacks columns {[f.name for f in new]}")
        if self.on_new_column == "add":
            for f in new:
                history = history.withColumn(f.name, F.lit(None).cast(f.dataType))
        return history

    def run(self, source: DataFrame, run_ts: object) -> int:
        """Take one snapshot of ``source``; returns the version of the history.

        A repeated ``run_ts`` changes nothing.
        """
        table = self.open_versions
        name = f"snapshot {run_ts}"
        if table.has_batch(name, 0):
            return table.version()
        history = self._with_columns_of(table.read(), source) if table.exists() else None
        after = snapshot(
            history,
            source,
            self.key,
            self.strategy,
            run_ts,
            self.check_cols,
            self.updated_at,
            self.hard_deletes,
            self.names,
        )
        version = table.next_version()
        ended = col(self.names.valid_to).isNotNull()
        with staged(self.spark, after) as stage:
            closed = stage.rows.where(ended)
            closed.write.mode("overwrite").parquet(f"{self.base}/closed/{RUN}={version}")
            return table.write(stage.rows.where(~ended), version, name, 0)
