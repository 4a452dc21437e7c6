"""A table that can only be asked, as a stream.

A poll asks for what lies beyond the last high-water mark, up to the mark of now, and lands it as a folder of files; the
stream reads the folders. A poll's two marks are written before its rows and never change, so a poll that failed is done
again for the same range, and its folder appears by one rename, whole or not at all. Together with the stream's
checkpoint every row of the source is taken once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import typed
from tidemark.functions.names import col, cols, require_columns
from tidemark.operators.incremental import incremental_filter, watermark_value
from tidemark.sources.versions import path_exists

POLL = "poll"


@dataclass(frozen=True)
class PolledTable:
    """Polls of one source below ``path``: ``marks/`` and ``rows/``, a folder each per poll.

    ``kind`` and ``lag`` as in :func:`tidemark.operators.incremental.incremental_filter`: a day-precision field is asked again from the
    last mark on, and ``lag`` from before it, so that late rows are found. What was asked again is in the stream
    again; let :func:`tidemark.streaming.streams.stream_dedupe_into` or a merge take it. Rows without a value in ``field`` are never
    beyond a mark: only the first poll takes them. One process polls at a time.
    """

    spark: SparkSession
    path: str
    field: str
    kind: str = "timestamp"
    lag: str | int | None = None

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def marks(self) -> DataFrame:
        """``(low, high, poll)`` of every poll; the first one has no ``low``."""
        schema = "low string, high string, poll int"
        if not path_exists(self.spark, f"{self.path}/marks"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/marks")

    def _last(self) -> tuple[int, str | None, str | None] | None:
        """The newest poll: its number is the only thing looked for, its line the only one read."""
        if not path_exists(self.spark, f"{self.path}/marks"):
            return None
        fs, folder = self._fs(f"{self.path}/marks")
        names = [str(s.getPath().getName()) for s in fs.listStatus(folder)]
        numbers = [int(n.removeprefix("poll=")) for n in names if n.startswith("poll=")]
        # A folder without its success file was never finished: its poll did not begin.
        for n in sorted(numbers, reverse=True):
            if path_exists(self.spark, f"{self.path}/marks/poll={n}/_SUCCESS"):
                r = self.spark.read.schema("low string, high string").parquet(f"{self.path}/marks/poll={n}").first()
                return n, r["low"], r["high"]
        return None

    def poll(self, source: DataFrame) -> int | None:
        """Land what is new in ``source``; the poll's number, or None if nothing is."""
        require_columns(source.columns, [self.field], "poll")
        last = self._last()
        if last is None or path_exists(self.spark, f"{self.path}/rows/{POLL}={last[0]}"):
            number, low = (0, None) if last is None else (last[0] + 1, last[2])
            high = watermark_value(source, self.field)
            again = self.lag is not None or self.kind in ("date", "yyyymmdd")
            if high is None or (high == low and not again):
                return None
            line = self.spark.createDataFrame([(low, high)], "low string, high string").coalesce(1)
            line.write.mode("overwrite").parquet(f"{self.path}/marks/{POLL}={number}")
        else:
            number, low, high = last
        self._land(source, number, low, high)
        return number

    def _land(self, source: DataFrame, number: int, low: str | None, high: str) -> None:
        beyond = incremental_filter(source, self.field, self.kind, low, lag=self.lag if low is not None else None)
        upto = col(self.field) <= typed(high, source.schema[self.field].dataType)
        rows = source.where(beyond & (upto if low is not None else upto | col(self.field).isNull()))
        landing, place = f"{self.path}/landing/{POLL}={number}", f"{self.path}/rows/{POLL}={number}"
        rows.write.mode("overwrite").parquet(landing)
        fs, target = self._fs(place)
        fs.mkdirs(target.getParent())
        if not fs.rename(self._fs(landing)[1], target):
            raise RuntimeError(f"could not move {landing} to {place}")

    def stream(self, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
        """The landed rows as a stream."""
        reader = self.spark.readStream.schema(T.StructType([*schema.fields, T.StructField(POLL, T.IntegerType())]))
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(f"{self.path}/rows").select(*cols(schema.names))

    def read(self, schema: T.StructType) -> DataFrame:
        """All landed rows, with the poll they came by."""
        landed = T.StructType([*schema.fields, T.StructField(POLL, T.IntegerType())])
        return self.spark.read.schema(landed).parquet(f"{self.path}/rows").select(*cols(schema.names), F.col(POLL))
