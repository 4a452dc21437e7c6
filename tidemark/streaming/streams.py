"""Structured Streaming forms of incremental sync.

Each micro-batch is written under its stream's id and its batch id, or commits them with its rows, so
replaying a batch after a failure has no further effect. The stream's id is the one Spark keeps in the
checkpoint: a new checkpoint, also one made at the place of a deleted one, is another stream, whose batches
are numbered from 0 again and replace nothing.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.change_log import append_log
from tidemark.operators.keys import dedupe, split_null_keys
from tidemark.operators.merge import not_older
from tidemark.operators.stage import staged
from tidemark.plans.sync import merge_into
from tidemark.sources.versions import VersionedTable, path_exists


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _each_batch(
    stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int, str], None]
) -> StreamingQuery:
    """Run ``process(batch, batch id, stream id)`` for all present input."""
    started = threading.Event()
    ids: list[str] = []

    def with_id(batch: DataFrame, batch_id: int) -> None:
        # The id is known once start() is back; the first batch may be here earlier.
        if not started.wait(timeout=600):
            raise RuntimeError("the stream's id did not become known")
        process(batch, batch_id, ids[0])

    query = (
        stream.writeStream.foreachBatch(with_id)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    ids.append(str(query.id))
    started.set()
    return query


def stream_merge(
    stream: DataFrame,
    table: VersionedTable,
    keys: str | Sequence[str],
    checkpoint: str,
    order_by: str | Sequence[str],
    mode: str = "incremental_sync",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into ``table``: clean, keep the latest row per key, merge.

    A batch becomes the table's next version, and its commit names the stream (by the id in its
    checkpoint) and the batch: only a batch that was committed is skipped on replay, whatever
    else wrote to the table between. By ``order_by`` the latest
    row of a key wins, in whichever batch it comes (of equal ones, the later batch).
    """
    keys, order_by = as_list(keys), as_list(order_by)

    def not_older_rows(rows: DataFrame, target: DataFrame) -> DataFrame:
        return not_older(rows, target, keys, order_by)

    def process(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        if table.has_batch(stream_id, batch_id):
            return
        rows = prepare(batch) if prepare else batch
        with staged(table.spark, dedupe(rows, keys, order_by)) as stage:
            if not stage.row_count:
                return
            # One row per key is left, so no further duplicate check. Files may arrive out
            # of order: rows older than what the table holds are dropped.
            merge_into(
                table,
                stage.rows,
                keys,
                mode,
                prepare=not_older_rows,
                stream=stream_id,
                batch_id=batch_id,
                on_duplicate="unique",
            )

    return _each_batch(stream, checkpoint, process)


def stream_change_log(
    stream: DataFrame, path: str, name: str, keys: str | Sequence[str], ts: str, checkpoint: str
) -> StreamingQuery:
    """Append each micro-batch to a change log partitioned by stream and batch.

    A batch writes its own folder and replaces it on replay; several streams, or one with a new
    checkpoint, add to one log. ``changed_at`` is taken from column ``ts`` of the rows, so a
    replay writes the same log.
    """

    def process(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        log = append_log(batch, name, keys, col(ts))
        log.write.mode("overwrite").parquet(f"{path}/stream={stream_id}/batch_id={batch_id}")

    return _each_batch(stream, checkpoint, process)


def stream_dedupe(
    stream: DataFrame, keys: str | Sequence[str], ts: str, delay: str = "1 day"
) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other.

    State is kept per key only until the watermark passes, so it stays bounded. The price: rows
    that arrive later than ``delay`` behind the newest one are dropped as well, also of keys
    never seen before. Where such rows must survive use :func:`stream_dedupe_into`.
    """
    keys = as_list(keys)
    event_time = "__event_time"
    # Watermarks need a zoned timestamp; a zone-less one is read in the session's zone.
    timed = stream.withColumn(event_time, F.col(ts).cast("timestamp"))
    unique = timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return unique.select(*cols(stream.columns))


DAY = "__day"
NUMBER = "__nth"


def _first_per_key(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The earliest row of each key; rows with a NULL in the key are all kept (SQL rule)."""
    keyed, unkeyed = split_null_keys(rows, keys)
    rest = [c for c in rows.columns if c != ts]
    w = Window.partitionBy(*cols(keys)).orderBy(col(ts).asc_nulls_last(), *cols(rest))
    first = keyed.withColumn(NUMBER, F.row_number().over(w)).where(F.col(NUMBER) == 1).drop(NUMBER)
    return first.unionByName(unkeyed)


@dataclass(frozen=True)
class UniqueRows:
    """What :func:`stream_dedupe_into` has written below ``path``.

    ``rows/`` holds the rows by stream, batch and day of event time, ``marks/`` one line per batch: the
    newest event time so far and how many rows went which way.
    """

    spark: SparkSession
    path: str

    def read(self, schema: T.StructType) -> DataFrame:
        stored = T.StructType(
            [*schema.fields, T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType()),
             T.StructField(DAY, T.DateType())]
        )
        return self.spark.read.schema(stored).parquet(f"{self.path}/rows")

    def rows(self, schema: T.StructType) -> DataFrame:
        return self.read(schema).select(*cols(schema.names))

    def marks(self) -> DataFrame:
        schema = (
            "newest string, on_time long, late long, repeated long, stream string, batch_id long"
        )
        return self.spark.read.schema(schema).parquet(f"{self.path}/marks")

    def newest(self, stream_id: str, batch_id: int) -> str | None:
        """The newest event time of all batches before this one: the batch before knows it; a
        stream's first batch asks all streams' lines once."""
        if not path_exists(self.spark, f"{self.path}/marks"):
            return None
        marks = self.marks()
        if batch_id:
            marks = marks.where((F.col("stream") == stream_id) & (F.col("batch_id") == batch_id - 1))
        else:
            marks = marks.where(F.col("stream") != stream_id)
        # Texts of one width sort like the times.
        return marks.agg(F.max("newest")).first()[0]


def stream_dedupe_into(
    stream: DataFrame,
    path: str,
    keys: str | Sequence[str],
    ts: str,
    checkpoint: str,
    delay: str = "1 day",
) -> StreamingQuery:
    """Write each key's first row below ``path``, however late it comes; see :class:`UniqueRows`.

    The watermark is the newest event time of earlier batches less ``delay``. A row is a repeat, and
    dropped, if its batch holds an earlier row of the key, or

    * on time (not behind the watermark): a row of the key was written with an event time less than
      ``delay`` behind the watermark. Only days from there on are read, so a batch costs the same
      however old the table is;
    * late: the key was written at any time. The table's key columns are read, once per batch that has late rows, and
      late rows are matched against them; what is new is written like other rows.

    So no row of an unseen key is lost and no late repeat gets in; a key that returns on time after more
    than ``delay`` is a new occurrence, as in :func:`stream_dedupe`. Rows without an event time are late; rows with a NULL in
    the key equal nothing and are all written. A replayed batch replaces what it wrote and never
    sees it. One stream at a time may write to ``path``; later ones, or one with a new checkpoint, find what
    earlier ones wrote.
    """
    keys, spark = as_list(keys), stream.sparkSession
    require_columns(stream.columns, [*keys, ts], "stream_dedupe_into")
    schema, out = stream.schema, UniqueRows(spark, path)
    event_time = col(ts).cast("timestamp_ntz")

    def process(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        newest = out.newest(stream_id, batch_id)
        mark = None if newest is None else F.expr(f"TIMESTAMP_NTZ '{newest}' - INTERVAL '{delay}'")
        on_time = F.lit(True) if mark is None else F.coalesce(event_time >= mark, F.lit(False))
        with staged(spark, batch) as stage:
            arrived = stage.rows
            first = _first_per_key(arrived, keys, ts)
            fresh, late = first.where(on_time), first.where(~on_time)
            if path_exists(spark, f"{path}/rows"):
                own = (F.col("stream") == stream_id) & (F.col("batch_id") == batch_id)
                written = out.read(schema).where(~own)
                if mark is not None:
                    since = F.expr(f"TIMESTAMP_NTZ '{newest}' - INTERVAL '{delay}' - INTERVAL '{delay}'")
                    recent = written.where((F.col(DAY) >= since.cast("date")) & (event_time >= since))
                    fresh = fresh.join(recent.select(*cols(keys)), keys, "left_anti")
                # Late rows are few: the keys among them that are known, then the rest.
                known = written.select(*cols(keys)).join(late.select(*cols(keys)), keys, "left_semi")
                if not late.isEmpty():
                    late = late.join(known.distinct(), keys, "left_anti")
            kept = fresh.withColumn("__late", F.lit(False)).unionByName(late.withColumn("__late", F.lit(True)))
            seen = Observation()
            counted = kept.observe(
                seen,
                F.coalesce(F.count_if(~F.col("__late")), F.lit(0)).alias("on_time"),
                F.coalesce(F.count_if(F.col("__late")), F.lit(0)).alias("late"),
            )
            place = f"stream={stream_id}/batch_id={batch_id}"
            (
                counted.drop("__late").withColumn(DAY, event_time.cast("date"))
                .write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/rows/{place}")
            )
            top = F.date_format(F.max(event_time), "yyyy-MM-dd HH:mm:ss.SSSSSS")
            n = seen.get
            arrived.agg(top.alias("t")).select(
                F.greatest(F.col("t"), F.lit(newest).cast("string")).alias("newest"),
                F.lit(n["on_time"]).cast("long").alias("on_time"),
                F.lit(n["late"]).cast("long").alias("late"),
                F.lit(stage.row_count - n["on_time"] - n["late"]).cast("long").alias("repeated"),
            ).coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/{place}")

    return _each_batch(stream, checkpoint, process)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet, exactly once, until all present input is read."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
