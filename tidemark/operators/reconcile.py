"""Reconciliation: is the target what the source says it should be?

Set comparisons follow the set rule (NULL equals NULL). No key leaves the cluster: keys
of both sides are grouped, with partial aggregation before the one shuffle, and only
counts come out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.keys import pair_by_key
from tidemark.operators.shape import unpivot_counts


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def side_by_side(*parts: DataFrame) -> DataFrame:
    """Several one-row frames as one row. They are stacked and folded, not joined."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*(F.max(col(c)).alias(c) for c in stacked.columns))


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both row counts and whether they agree."""
    both = side_by_side(_count(source, "source_count"), _count(target, "target_count"))
    return both.withColumn("is_valid", F.col("source_count") == F.col("target_count"))


def reconcile_keys(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    where: str | Column | None = None,
    filter_target: bool = True,
) -> DataFrame:
    """One row: counts, distinct keys missing in and extra in the target, ``is_valid``.

    ``where`` limits the source, and the target too unless ``filter_target`` is off (then
    every target row outside the filter counts as extra).
    """
    keys = as_list(keys)
    if where is not None:
        source = source.where(where)
        target = target.where(where) if filter_target else target
    sides = source.select(*cols(keys), F.lit(1).alias("__s"), F.lit(0).alias("__t")).unionByName(
        target.select(*cols(keys), F.lit(0).alias("__s"), F.lit(1).alias("__t"))
    )
    per_key = sides.groupBy(*cols(keys)).agg(F.sum("__s").alias("s"), F.sum("__t").alias("t"))
    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_count"),
        F.count_if(F.col("t") == 0).alias("missing_in_target"),
        F.count_if(F.col("s") == 0).alias("extra_in_target"),
    ).withColumn("is_valid", (F.col("missing_in_target") == 0) & (F.col("extra_in_target") == 0))


def key_differences(
    source: DataFrame, target: DataFrame, keys: str | Sequence[str]
) -> DataFrame:
    """The differing keys themselves, with ``side``: missing_in_target / extra_in_target."""
    keys = as_list(keys)
    sides = source.select(*cols(keys), F.lit(True).alias("__s")).unionByName(
        target.select(*cols(keys), F.lit(False).alias("__s"))
    )
    return (
        sides.groupBy(*cols(keys))
        .agg(F.bool_or("__s").alias("s"), F.bool_and("__s").alias("only_s"))
        .where("only_s OR NOT s")
        .select(
            *cols(keys),
            F.when(F.col("only_s"), "missing_in_target").otherwise("extra_in_target").alias("side"),
        )
    )


def reconcile_incremental(
    source: DataFrame, target: DataFrame, where: str | Column
) -> DataFrame:
    """One row: the filtered source against the whole target, by count."""
    both = side_by_side(
        _count(source.where(where), "source_incremental_count"), _count(target, "target_count")
    )
    gap = F.col("source_incremental_count") - F.col("target_count")
    return both.select(
        "source_incremental_count",
        "target_count",
        F.greatest(F.lit(0), gap).alias("missing_count"),
        F.greatest(F.lit(0), -gap).alias("extra_count"),
        (gap == 0).alias("is_valid"),
    )


def reconcile_rows(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per column: keys present on both sides, and how many of them differ in value."""
    keys = as_list(keys)
    if columns is None:
        columns = [c for c in source.columns if c in target.columns and c not in keys]
    require_columns(source.columns, columns, "source")
    require_columns(target.columns, columns, "target")
    wanted = [*keys, *columns]
    pairs = pair_by_key(source.select(*cols(wanted)), target.select(*cols(wanted)), keys)
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    aggs: list[Column] = []
    for i, c in enumerate(columns):
        differs = ~F.col("before")[c].eqNullSafe(F.col("after")[c])
        aggs += [
            F.count_if(both).alias(f"{i}_compared"),
            F.count_if(both & differs).alias(f"{i}_mismatches"),
        ]
    return unpivot_counts(pairs.agg(*aggs), list(columns), ["compared", "mismatches"])


def reconcile_multi(source: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per target: its count against the source's, and whether all targets match."""
    rows = [_count(source, "n").withColumn("target", F.lit(None).cast("string"))]
    for name, df in targets.items():
        rows.append(_count(df, "n").withColumn("target", F.lit(name)))
    is_source = F.col("target").isNull()
    # One row per target, so the list is as short as the list of targets.
    folded = reduce(DataFrame.unionByName, rows).agg(
        F.max(F.when(is_source, F.col("n"))).alias("source_count"),
        F.collect_list(
            F.when(~is_source, F.struct("target", F.col("n").alias("target_count")))
        ).alias("counts"),
    )
    same = F.forall("counts", lambda c: c["target_count"] == F.col("source_count"))
    return folded.select("source_count", same.alias("all_valid"), F.inline("counts")).select(
        "target",
        "target_count",
        "source_count",
        (F.col("target_count") == F.col("source_count")).alias("is_valid"),
        "all_valid",
    )


def version_distribution(df: DataFrame, version: str) -> DataFrame:
    """One row: rows, lowest, highest, rounded mean and sample deviation, and range."""
    v = col(version)

    def rounded(c: Column) -> Column:
        return F.coalesce(F.round(c).cast("long"), F.lit(0))

    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(v).alias("min_version"),
        F.max(v).alias("max_version"),
        rounded(F.avg(v)).alias("avg_version"),
        rounded(F.stddev_samp(v)).alias("stddev_version"),
        F.coalesce(F.max(v) - F.min(v), F.lit(0)).alias("version_range"),
    )


def version_sync_status(
    source: DataFrame, target: DataFrame, version: str, target_version: str = "source_version"
) -> DataFrame:
    """One row: highest source version, last one in the target, gap, and both counts."""
    left = source.agg(
        F.coalesce(F.max(col(version)), F.lit(0)).alias("source_max_version"),
        F.count(F.lit(1)).alias("source_count"),
    )
    right = target.agg(
        F.coalesce(F.max(col(target_version)), F.lit(0)).alias("target_last_version"),
        F.count(F.lit(1)).alias("target_count"),
    )
    highest, last = F.col("source_max_version"), F.col("target_last_version")
    return side_by_side(left, right).select(
        "source_max_version",
        "target_last_version",
        ((highest <= 0) | (last >= highest)).alias("is_synchronized"),
        F.when(highest > 0, F.greatest(F.lit(0), highest - last)).otherwise(0).alias("sync_gap"),
        "source_count",
        "target_count",
    )


# What an out-of-sync target loses from a score of 1.
NOT_SYNCED_PENALTY = 0.3
GAP_PENALTIES = [(1_000_000, 0.2), (100_000, 0.1)]
COUNT_PENALTY = 0.2


def integrity_score(status: DataFrame) -> DataFrame:
    """Add ``integrity_score`` (0 to 1) to a :func:`version_sync_status` row."""
    gap = F.col("sync_gap")
    s, t = F.col("source_count"), F.col("target_count")
    by_gap = F.lit(0.0)
    for limit, penalty in reversed(GAP_PENALTIES):
        by_gap = F.when(gap > limit, F.lit(penalty)).otherwise(by_gap)
    ratio = F.least(s, t) / F.greatest(s, t)
    by_count = F.when((s > 0) & (t > 0), (1.0 - ratio) * COUNT_PENALTY).otherwise(0.0)
    by_sync = F.when(F.col("is_synchronized"), 0.0).otherwise(NOT_SYNCED_PENALTY)
    score = F.greatest(F.lit(0.0), 1.0 - by_sync - by_gap - by_count)
    return status.withColumn("integrity_score", score)
