"""Versioned Parquet tables: a table is never overwritten while it is read.

Each write goes to a new folder ``v=<n>``; a row appended to the small commit log makes it
the current version. A write that fails leaves no commit row, so readers keep the previous
version; the next write reuses the number. There is one writer per table at a time.

A table may be split into key buckets. Then a commit row names one bucket, and a merge
rewrites only the buckets that hold staged keys and carries the others by reference. Each
commit records how its buckets were made (keys, their types, number); a table that is opened
with another layout is read whole and written anew in it once.

A commit may name the stream and batch it came from, so that a replayed batch is known.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_list, cols

COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("layout", T.StringType()),
        T.StructField("is_full", T.BooleanType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
BUCKET = "__bucket"
WHOLE = -1


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist in whatever file system its URL names?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def counted_write(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write Parquet and return the number of rows, counted in the same pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return int(seen.get.get("row_count") or 0)


@dataclass(frozen=True)
class VersionedTable:
    """A table below the folder ``base``, which every executor can reach."""

    spark: SparkSession
    base: str

    @property
    def _log(self) -> str:
        return f"{self.base}/commits"

    def commits(self) -> DataFrame | None:
        """The commit log, None before the first commit."""
        if not path_exists(self.spark, self._log):
            return None
        return self.spark.read.schema(COMMIT).json(self._log)

    def version(self, below: int | None = None) -> int | None:
        """The current version, or the newest one below ``below``."""
        log = self.commits()
        if log is None:
            return None
        if below is not None:
            log = log.where(F.col("version") < below)
        return log.agg(F.max("version")).first()[0]

    def exists(self) -> bool:
        return self.version() is not None

    def _entries(self, version: int | None = None) -> list:
        """Newest commit row of each bucket, as of ``version`` or now.

        A commit of the full table replaces all that came before it. What reaches the driver is
        one row per bucket, a number the writer fixed.
        """
        log = self.commits()
        if log is None:
            return []
        if version is not None:
            log = log.where(F.col("version") <= version)
        newest = log.groupBy("bucket").agg(
            F.max_by(
                F.struct("path", "row_count", "table_schema", "version", "layout"), "version"
            ).alias("e"),
            F.max(F.when(F.col("is_full"), F.col("version"))).alias("full_version"),
        )
        entries = newest.select("bucket", "e.*", "full_version").collect()
        full = max((e["full_version"] or 0 for e in entries), default=0)
        return [e for e in entries if e["version"] >= full]

    def layout(self) -> str | None:
        """How the current version is split, None for a table in one piece or none at all."""
        entries = self._entries()
        return max(entries, key=lambda e: e["version"])["layout"] if entries else None

    def has_batch(self, stream: str, batch_id: int) -> bool:
        """Was this batch of this stream committed?"""
        log = self.commits()
        if log is None:
            return False
        return not log.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty()

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table at ``version`` (the current one by default), or some of its buckets."""
        entries = self._entries(version)
        if not entries:
            raise FileNotFoundError(f"no committed version below {self.base}")
        latest = max(entries, key=lambda e: e["version"])
        schema = T.StructType.fromJson(json.loads(latest["table_schema"]))
        wanted = entries if buckets is None else [e for e in entries if e["bucket"] in set(buckets)]
        paths = [e["path"] for e in wanted if e["row_count"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _append(self, rows: list[tuple]) -> None:
        # The rows travel as one literal: no Python worker, one small file.
        text = json.dumps([dict(zip(COMMIT.fieldNames(), r, strict=True)) for r in rows])
        parsed = F.from_json(F.lit(text), T.ArrayType(COMMIT))
        commit = self.spark.range(0, 1, 1, 1).select(F.inline(parsed))
        commit.write.mode("append").json(self._log)

    def next_version(self) -> int:
        return (self.version() or 0) + 1

    def write(
        self,
        df: DataFrame,
        version: int | None = None,
        stream: str | None = None,
        batch_id: int | None = None,
    ) -> int:
        """Write the whole table as a new version and commit it; returns the version.

        With an explicit ``version`` that is committed already nothing is written, so a
        replayed micro-batch has no effect.
        """
        current = self.version()
        if version is None:
            version = (current or 0) + 1
        elif current is not None and current >= version:
            return version
        path = f"{self.base}/v={version}"
        rows = counted_write(df, path)
        self._append([(version, WHOLE, path, rows, df.schema.json(), None, True, stream, batch_id)])
        return version

    def row_count(self) -> int:
        """Rows of the current version, from the commit log alone."""
        return sum(e["row_count"] for e in self._entries())


def bucket_of(keys: str | Sequence[str], n: int, types: Sequence[str] | None = None) -> Column:
    """The bucket of a key, 0 to n - 1. The hash depends on the key's type: ``types`` are those
    the keys are cast to first."""
    columns = cols(as_list(keys))
    if types is not None:
        columns = [F.col(c).cast(t) for c, t in zip(columns, types, strict=True)]
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


@dataclass(frozen=True)
class BucketedTable(VersionedTable):
    """A versioned table split into ``n`` buckets by its merge keys.

    Choose ``n`` so that a bucket is a few files' worth. A small delta then costs its own
    buckets, not the table.
    """

    keys: tuple[str, ...]
    n: int

    def layout_of(self, schema: T.StructType) -> str:
        types = [schema[k].dataType.simpleString() for k in self.keys]
        return json.dumps({"keys": list(self.keys), "types": types, "n": self.n})

    def stored_types(self) -> list[str] | None:
        """Types of the stored keys if the table is split the way this object says."""
        found = json.loads(self.layout() or "{}")
        same = found.get("keys") == list(self.keys) and found.get("n") == self.n
        return found["types"] if same else None

    def touched(self, stage: DataFrame) -> list[int]:
        """Buckets of the stored table that hold staged keys: at most ``n`` small numbers."""
        types = self.stored_types()
        if types is None:
            raise ValueError(f"{self.base} is not split by {self.keys} into {self.n} buckets")
        found = stage.select(bucket_of(self.keys, self.n, types).alias(BUCKET)).distinct().collect()
        return sorted(r[0] for r in found)

    def write_buckets(
        self,
        df: DataFrame,
        buckets: Sequence[int],
        version: int | None = None,
        stream: str | None = None,
        batch_id: int | None = None,
    ) -> int:
        """Replace ``buckets`` by the rows of ``df`` and commit; other buckets stay.

        Raises when ``df`` has rows of other buckets, or when only some buckets are written
        to a table that is split in another way.
        """
        full = set(buckets) == set(range(self.n))
        layout = self.layout_of(df.schema)
        if not full and self.layout() != layout:
            raise ValueError(f"{self.base} is split in another way: {self.layout()}, not {layout}")
        current = self.version()
        if version is None:
            version = (current or 0) + 1
        elif current is not None and current >= version:
            return version
        if not buckets:
            return current or 0
        path = f"{self.base}/v={version}"
        # Rebalance by bucket: few files per bucket, and a large bucket is split.
        types = json.loads(layout)["types"]
        rows = df.withColumn(BUCKET, bucket_of(self.keys, self.n, types)).hint("rebalance", BUCKET)
        counted_write(rows, path, partition_by=BUCKET)
        schema = df.schema.json()
        written = (
            self.spark.read.schema(T.StructType([T.StructField(BUCKET, T.IntegerType())]))
            .parquet(path)
            .groupBy(BUCKET)
            .count()
            .collect()
        )
        counts = {r[0]: r[1] for r in written}
        if not set(counts) <= set(buckets):
            raise RuntimeError(f"rows of buckets {sorted(set(counts) - set(buckets))} are not committed")
        self._append(
            [
                (version, b, f"{path}/{BUCKET}={b}", counts.get(b, 0), schema, layout, full, stream, batch_id)
                for b in buckets
            ]
        )
        return version

    def write(
        self,
        df: DataFrame,
        version: int | None = None,
        stream: str | None = None,
        batch_id: int | None = None,
    ) -> int:
        return self.write_buckets(df, range(self.n), version, stream, batch_id)
