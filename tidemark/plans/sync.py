"""Table syncs: extract, stage, merge, write a new version, check, one result row.

Relations to the operators: ``full_copy`` replaces the target; ``full_sync`` merges and
deletes what the source lost; ``version_sync`` extracts rows with a newer row version and
carries the version along; ``incremental_sync`` (or ``incremental``) extracts beyond the
target's high-water mark and upserts; ``delete_insert`` and ``insert_ignore`` merge the
extract that way; ``cdc`` upserts and appends to a change log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_list, check_identifier, cols
from tidemark.operators.audit import append_run
from tidemark.operators.change_log import append_log, diff, to_log
from tidemark.operators.incremental import (
    incremental_filter,
    incremental_version,
    predicate,
    version_mode,
    watermark_value,
)
from tidemark.operators.keys import resolve_duplicates
from tidemark.operators.lookup import rows_of_keys
from tidemark.operators.merge import merge
from tidemark.operators.reconcile import reconcile_keys
from tidemark.operators.shape import clean, conform, lost_values
from tidemark.operators.stage import staged
from tidemark.sources.scan import scan
from tidemark.sources.versions import BucketedTable, VersionedTable
from tidemark.spec import SyncSpec, TargetSpec

RESULT = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("staged_rows", T.LongType()),
        T.StructField("target_rows", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("missing_in_target", T.LongType()),
        T.StructField("extra_in_target", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("message", T.StringType()),
    ]
)

# How a sync mode merges its extract.
MERGE_OF = {
    "full_sync": "full_sync",
    "incremental_sync": "upsert",
    "incremental": "upsert",
    "delete_insert": "delete_insert",
    "insert_ignore": "insert_ignore",
    "cdc": "upsert",
    "version_sync": "versioned",
}


# The target column that keeps the source's row version.
VERSION = "source_version"

# Modes whose result depends on the whole source: no bucket is left out.
WHOLE_TABLE_MODES = ("full_copy", "full_sync")


def table_at(
    spark: SparkSession,
    base: str,
    name: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> VersionedTable:
    path = f"{base.rstrip('/')}/{check_identifier(name)}"
    return BucketedTable(spark, path, tuple(keys), buckets) if buckets else VersionedTable(spark, path)


def merge_into(
    table: VersionedTable,
    rows: DataFrame,
    keys: Sequence[str],
    mode: str,
    version: int | None = None,
    prepare=None,
    stream: str | None = None,
    batch_id: int | None = None,
    **options,
) -> int:
    """Merge staged ``rows`` into ``table`` as its next version (or as ``version``).

    A bucketed table reads and writes only the buckets of the staged keys, unless the mode
    is about the whole table. ``prepare(rows, target)`` may drop rows that should not be
    merged. Returns the version.
    """
    base = table.version(below=version)
    if base is None:
        before = table.spark.createDataFrame([], rows.schema)
        return table.write(sync_by_mode(before, rows, keys, mode, **options), version, stream, batch_id)
    by_bucket = isinstance(table, BucketedTable) and mode not in WHOLE_TABLE_MODES
    # A table that was split in another way, or not at all, is written anew as a whole.
    if by_bucket and table.stored_types() is not None:
        buckets = table.touched(rows)
        before = table.read(base, buckets)
    else:
        buckets, before = None, table.read(base)
    if prepare:
        rows = prepare(rows, before)
    merged = sync_by_mode(before, rows, keys, mode, **options)
    if buckets is None:
        return table.write(merged, version, stream, batch_id)
    return table.write_buckets(merged, buckets, version, stream, batch_id)


def full_load(table: VersionedTable, source: DataFrame) -> int:
    """Replace the target by the source as a new version; ``source`` may read the target."""
    return table.write(source)


def extract(
    spark: SparkSession,
    spec: SyncSpec,
    target: DataFrame | None,
    run_ts: object = None,
    lost: Observation | None = None,
) -> DataFrame:
    """The source rows a sync has to look at, cleaned and shaped if the spec says how.

    ``lost`` gets the number of values per column that do not fit the shape, in the same pass.

    The filter is on the source's own columns, so it reaches the scan.
    """
    source = scan(spark, spec.source)
    beyond = None
    if spec.mode in ("incremental_sync", "incremental"):
        takes_mark = spec.where is None or spec.combine == "and"
        if takes_mark:
            hwm = watermark_value(target, spec.incremental_field)
            beyond = incremental_filter(
                source, spec.incremental_field, spec.incremental_type, hwm, lag=spec.lag
            )
    if spec.mode == "version_sync":
        last = watermark_value(target, VERSION)
        rows = incremental_version(
            source, spec.incremental_field, None if last is None else int(last), spec.where, VERSION
        )
    else:
        rows = source.where(predicate(spec.where, None, beyond, spec.combine))
    if spec.shape:
        rows = clean(rows, spec.shape)
        counts = lost_values(rows, spec.shape) if lost else []
        rows = conform(rows.observe(lost, *counts) if counts else rows, spec.shape, run_ts)
    return rows


def check_lost(spec: SyncSpec, lost: Observation) -> dict:
    """Raise for values that were lost, or name them in the result row, as the spec says."""
    counts = {c: n for c, n in lost.get.items() if n}
    if counts and spec.on_bad_value == "error":
        raise ValueError(f"{spec.target}: values that do not fit: {counts}")
    return {"message": f"values that do not fit: {counts}"} if counts else {}


def sync_by_mode(
    target: DataFrame, source: DataFrame, keys: Sequence[str], mode: str, **options
) -> DataFrame:
    """The next target under a sync mode, lazily; unknown modes are an error.

    ``source`` is the whole source for ``full_copy`` and ``full_sync`` and the extract for
    the others.
    """
    if mode == "full_copy":
        return source
    if mode not in MERGE_OF:
        raise ValueError(f"unknown sync mode: {mode!r}")
    return merge(target, source, list(keys), MERGE_OF[mode], **options)


def sync_table(spark: SparkSession, spec: SyncSpec, base: str, run_ts: object) -> dict:
    """Run one sync below the folder ``base``; returns the fields of a result row."""
    table = table_at(spark, base, spec.target, spec.keys, spec.buckets)
    current = table.read() if table.exists() else None
    lost = Observation()
    if spec.mode == "version_sync" and versions_too_wide(spark, spec):
        # Every row is taken again and merged by version; nothing is deleted.
        rows = extract(spark, spec, None, run_ts, lost)
    else:
        rows = extract(spark, spec, current, run_ts, lost)
    if spec.mode == "full_copy" and not spec.shape:
        full_load(table, rows)
        found = check_keys(spec, rows, table) if spec.check_keys else {}
        return {"staged_rows": table.row_count(), **_outcome(table), **found}
    with staged(spark, rows) as stage:
        bad = check_lost(spec, lost) if spec.shape else {}
        if spec.mode == "full_copy":
            full_load(table, stage.rows)
            found = check_keys(spec, stage.rows, table) if spec.check_keys else {}
            return {"staged_rows": stage.row_count, **_outcome(table), **found, **bad}
        if not stage.row_count and current is not None and spec.mode not in WHOLE_TABLE_MODES:
            # Nothing new: the target is not rewritten.
            return {"staged_rows": 0, **_outcome(table), **bad}
        version = table.next_version()
        rows, options = stage.rows, {"on_duplicate": spec.on_duplicate, "order_by": spec.order_by}
        if spec.mode == "cdc":
            rows, options = one_per_key(rows, spec.keys, **options), {"on_duplicate": "unique"}
            write_changes(current, rows, spec.target, spec.keys, base, version, run_ts, stage.rows)
        merge_into(table, rows, spec.keys, spec.mode, version, run_ts=run_ts, **options)
        found = check_keys(spec, stage.rows, table) if spec.check_keys else {}
        return {"staged_rows": stage.row_count, **_outcome(table), **found, **bad}


def one_per_key(
    rows: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """Staged rows as the log and the table both take them: the policy for repeated keys applied."""
    if on_duplicate == "keep":
        raise ValueError("a change log needs one row per key; on_duplicate can't be 'keep'")
    return resolve_duplicates(rows, list(keys), on_duplicate, as_list(order_by))


def write_changes(
    current: DataFrame | None,
    rows: DataFrame,
    name: str,
    keys: Sequence[str],
    base: str,
    version: int,
    run_ts: object,
    stage: DataFrame | None = None,
) -> None:
    """Log what ``rows`` change in the stored table: INSERT and UPDATE with old and new values,
    nothing for rows that are equal. Stored rows that an extract lacks are no deletions. ``rows``
    hold a key once (:func:`one_per_key`); ``stage`` has their keys, as a table that is cheap to read.

    The folder is named by version and replaced as a whole: a retry does not log twice.
    """
    if current is None:
        log = append_log(rows, name, keys, run_ts)
    else:
        before = rows_of_keys(current.select(*cols(rows.columns)), rows if stage is None else stage, keys)
        log = to_log(diff(before, rows, list(keys)), name, list(keys), run_ts)
    log.write.mode("overwrite").parquet(f"{base}/{name}_cdc/version={version}")


def versions_too_wide(spark: SparkSession, spec: SyncSpec) -> bool:
    """Must a version sync look at every row? Raises when no row has a version."""
    chosen = version_mode(
        scan(spark, spec.source), spec.incremental_field, spec.version_range_limit
    ).first()["mode"]
    if chosen == "incremental_timestamp":
        raise ValueError(f"{spec.target}: no row has a version; sync by a timestamp instead")
    return chosen == "full_sync"


def _outcome(table: VersionedTable) -> dict:
    return {"target_rows": table.row_count(), "version": table.version()}


def check_keys(spec: SyncSpec, rows: DataFrame, table: VersionedTable) -> dict:
    """Compare staged with target keys; raises when the target lacks one, or, where the
    target should equal the source, has one too many."""
    counts = reconcile_keys(rows, table.read(), list(spec.keys)).first()
    missing, extra = counts["missing_in_target"], counts["extra_in_target"]
    if missing or (extra and spec.mode in WHOLE_TABLE_MODES):
        raise RuntimeError(f"{spec.target}: {missing} keys missing, {extra} keys extra")
    return {"missing_in_target": missing, "extra_in_target": extra}


def sync_all(
    spark: SparkSession,
    specs: Sequence[SyncSpec],
    base: str,
    run_ts: object = None,
    max_concurrent: int = 2,
    log_path: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Sync every enabled table, a few at a time; one result row each, failures included.

    The threads only submit Spark jobs, each in a scheduler pool of its own. With
    ``log_path`` each table is also a step of run ``run_id`` in that run log.
    """
    run_ts = run_ts or _now()

    def run(spec: SyncSpec) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.target)
        row = {"target": spec.target, "mode": spec.mode, "started_at": _now()}
        try:
            row |= {"status": "completed", **sync_table(spark, spec, base, run_ts)}
        except Exception as e:  # one table's failure must not stop the others
            row |= {"status": "failed", "message": f"{type(e).__name__}: {e}"}
        return row | {"ended_at": _now()}

    with ThreadPoolExecutor(max_workers=max_concurrent) as pool:
        work = inheritable_thread_target(spark)(run)
        results = list(pool.map(work, [s for s in specs if s.enabled]))
    if log_path:
        append_run(spark, log_path, [_log_row(r, run_id or str(run_ts)) for r in results])
    rows = [tuple(r.get(f) for f in RESULT.fieldNames()) for r in results]
    return spark.createDataFrame(rows, RESULT)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _log_row(result: dict, run_id: str) -> dict:
    started, ended = result["started_at"], result["ended_at"]
    return {
        "run_id": run_id,
        "pipeline": result["target"],
        "step": result["mode"],
        "status": result["status"],
        "started_at": started,
        "ended_at": ended,
        "duration_s": (ended - started).total_seconds(),
        "rows_copied": result.get("staged_rows"),
        "error_count": int(result["status"] == "failed"),
        "message": result.get("message"),
    }


def fan_out_counts(source: DataFrame, targets: Sequence[TargetSpec]) -> DataFrame:
    """(target, row_count) each target would get: one scan for all of them."""
    row = source.agg(
        *(
            F.count_if(F.expr(t.where) if t.where else F.lit(True)).alias(f"t{i}")
            for i, t in enumerate(targets)
        )
    )
    entries = [
        F.struct(F.lit(t.name).alias("target"), F.col(f"t{i}").alias("row_count"))
        for i, t in enumerate(targets)
    ]
    return row.select(F.inline(F.array(*entries)))


def fan_out(
    spark: SparkSession,
    source: DataFrame,
    targets: Sequence[TargetSpec],
    base: str,
    keys: Sequence[str] = (),
    run_ts: object = None,
    max_concurrent: int = 2,
) -> DataFrame:
    """Write one source to several targets, each with its own mode and filter, a few at a time.

    A target's first load goes through the same merge as later ones, so its policy for
    repeated keys holds from the start. ``keys`` are those of targets that name none.

    Returns (target, row_count), or raises when any target failed. Each target scans the
    source with its own filter: on files that reads less than caching the whole source
    would, and a lost executor costs a task, not the cache.
    """
    run_ts = run_ts or _now()

    def run(t: TargetSpec) -> tuple[str, int | None, str | None]:
        try:
            table = table_at(spark, base, t.name)
            mine = source.where(t.where) if t.where else source
            own_keys = t.keys or tuple(as_list(keys))
            if t.mode == "full_copy":
                full_load(table, mine)
                return t.name, table.row_count(), None
            if not own_keys:
                raise ValueError(f"{t.mode} needs at least one key column")
            options = {"on_duplicate": t.on_duplicate, "order_by": t.order_by, "run_ts": run_ts}
            with staged(spark, mine) as stage:
                rows = stage.rows
                if t.mode == "cdc":
                    rows = one_per_key(rows, own_keys, t.on_duplicate, t.order_by)
                    options["on_duplicate"] = "unique"
                    current = table.read() if table.exists() else None
                    write_changes(
                        current, rows, t.name, own_keys, base, table.next_version(), run_ts, stage.rows
                    )
                merge_into(table, rows, own_keys, t.mode, **options)
            return t.name, table.row_count(), None
        except Exception as e:  # the other targets go on
            return t.name, None, f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max_workers=max_concurrent) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(run), targets))
    failures = {name: message for name, _, message in results if message}
    if failures:
        raise RuntimeError(f"targets failed: {failures}")
    return spark.createDataFrame([r[:2] for r in results], "target string, row_count long")
