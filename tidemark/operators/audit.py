"""Run audit: a log of sync runs as a table, and the reports on it.

Reports group by pipeline with partial aggregation, so one pipeline may own most of the
log. Only fixed-size aggregates are used; none gathers a pipeline's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_list, col, cols

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("rows_copied", T.LongType()),
        T.StructField("checkpoint_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("warning_count", T.LongType()),
        T.StructField("memory_mb", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class Thresholds:
    """When a pipeline counts as unhealthy."""

    # The default alert limits.
    execution_time_minutes: float = 60
    success_rate_percent: float = 90.0
    error_count: int = 3
    memory_usage_mb: float = 2048


def append_run(spark: SparkSession, path: str, rows: Sequence[dict]) -> None:
    """Append step records to the run log; missing fields are NULL."""
    unknown = {k for r in rows for k in r} - set(RUN_LOG.fieldNames())
    if unknown:
        raise ValueError(f"not in the run log: {sorted(unknown)}")
    records = [tuple(r.get(f) for f in RUN_LOG.fieldNames()) for r in rows]
    spark.createDataFrame(records, RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def run_log(df: DataFrame) -> DataFrame:
    """Any table of runs in the run log's shape: known columns cast, others added as NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RUN_LOG.fields
        )
    )


def _status(name: str) -> Column:
    return F.count_if(F.col("status") == name)


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def progress(log: DataFrame, by: str | Sequence[str] = "run_id") -> DataFrame:
    """Per run: steps in total, completed, failed and running, and percent completed."""
    return (
        log.groupBy(*cols(as_list(by)))
        .agg(
            F.count(F.lit(1)).alias("total_steps"),
            _status("completed").alias("completed_steps"),
            _status("failed").alias("failed_steps"),
            _status("running").alias("running_steps"),
        )
        .withColumn(
            "progress_percentage", _percent(F.col("completed_steps"), F.col("total_steps"))
        )
    )


def health(log: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Per pipeline: the figures behind each alert, and a flag per exceeded limit."""
    memory = F.max("memory_mb") if "memory_mb" in log.columns else F.lit(None).cast("double")
    figures = log.groupBy("pipeline").agg(
        (F.max("duration_s") / 60).alias("longest_minutes"),
        _percent(_status("completed"), F.count_if(F.col("status") != "running")).alias(
            "success_rate_percent"
        ),
        F.coalesce(F.max("error_count"), F.lit(0)).alias("most_errors"),
        memory.alias("peak_memory_mb"),
    )

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    slow = flag(F.col("longest_minutes") > limits.execution_time_minutes)
    failing = flag(F.col("success_rate_percent") < limits.success_rate_percent)
    errors = flag(F.col("most_errors") >= limits.error_count)
    memory_high = flag(F.col("peak_memory_mb") > limits.memory_usage_mb)
    return figures.select(
        "*",
        slow.alias("is_slow"),
        failing.alias("is_failing"),
        errors.alias("has_many_errors"),
        memory_high.alias("is_memory_high"),
        (~(slow | failing | errors | memory_high)).alias("is_healthy"),
    )


def throughput(log: DataFrame) -> DataFrame:
    """Each run with ``rows_per_second`` and ``rows_per_mb``; 0 where the divisor is not
    positive."""

    def rate(divisor: str) -> Column:
        positive = F.when(col(divisor) > 0, col(divisor))
        return F.coalesce(F.try_divide(F.col("rows_copied"), positive), F.lit(0.0))

    return log.withColumns(
        {"rows_per_second": rate("duration_s"), "rows_per_mb": rate("memory_mb")}
    )


def chunk_timings(
    log: DataFrame,
    by: str,
    order_by: Sequence[str],
    last: int = 100,
    duration: str = "duration_s",
    memory: str = "memory_mb",
) -> DataFrame:
    """Per run: average time of its last chunks, overall times, average and peak memory.

    The last chunks are a top-``last`` per run, which is cut down in every task before the
    shuffle; a running frame over all chunks of a run would need them in one task.
    """
    w = Window.partitionBy(col(by)).orderBy(*(col(o).desc() for o in order_by))
    recent = (
        log.select(*cols(dict.fromkeys([by, *order_by, duration])))
        .withColumn("__rank", F.row_number().over(w))
        .where(F.col("__rank") <= last)
        .groupBy(col(by))
        .agg(F.avg(col(duration)).alias("recent_avg_s"))
    )
    overall = log.groupBy(col(by)).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.avg(col(duration)).alias("avg_s"),
        F.min(col(duration)).alias("min_s"),
        F.max(col(duration)).alias("max_s"),
        F.avg(col(memory)).alias("avg_memory_mb"),
        F.max(col(memory)).alias("max_memory_mb"),
    )
    # The run without an id is a run like others.
    other = recent.withColumnRenamed(by, "__by")
    return overall.join(other, col(by).eqNullSafe(F.col("__by"))).drop("__by")


def summary(log: DataFrame) -> DataFrame:
    """Per pipeline, and over all (``pipeline`` = ``ALL``): runs by status, last success,
    average minutes, success rate."""
    done = F.col("status") == "completed"
    return (
        log.rollup("pipeline")
        .agg(
            F.grouping("pipeline").alias("is_total"),
            F.count(F.lit(1)).alias("runs"),
            _status("completed").alias("completed_runs"),
            _status("failed").alias("failed_runs"),
            _status("running").alias("running_runs"),
            F.max(F.when(done, F.col("started_at"))).alias("last_successful_run"),
            F.avg(F.col("duration_s") / 60).alias("avg_execution_time_minutes"),
            _percent(_status("completed"), F.count_if(F.col("status") != "running")).alias(
                "success_rate_percent"
            ),
        )
        .withColumn(
            "pipeline", F.when(F.col("is_total") == 1, "ALL").otherwise(F.col("pipeline"))
        )
        .drop("is_total")
    )
