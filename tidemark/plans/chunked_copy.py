"""A copy in chunks of equal row counts that goes on where it stopped.

The chunks are ranges of the key, planned once and stored: a quantile sketch of the keys finds bounds between which
about equally many rows lie, however unevenly the keys are spread. A chunk is copied into a folder of its own and
then entered in the ledger; what a stopped run left without an entry is written again, what has one is
not read again. A chunk's filter is a range of the key and reaches the files or the database.

An entry holds the digest of the chunk's rows, so a later run also finds out which chunks the source
has changed meanwhile, without comparing rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import as_list, col, cols, require_columns
from tidemark.operators.digests import PARTS, row_hashes
from tidemark.operators.keys import any_null
from tidemark.operators.ranges import Bound, range_of, sampled_bounds, types_of, within
from tidemark.operators.sketches import ordinal_of, value_of
from tidemark.sources.versions import path_exists

# Rank error of a bound about 0.04 %: a tenth of a chunk at 256 chunks.
SKETCH_K = 8_000
CHUNK = "__chunk"
# The chunk of rows with a NULL in the key.
NO_KEY = -1


def equal_bounds(source: DataFrame, keys: Sequence[str], chunks: int) -> list[tuple[str, ...]]:
    """At most ``chunks - 1`` keys, ascending, with about equally many rows between them.

    One numeric, date or time key: quantiles of a sketch, one scan of the key column. Other keys: a uniform sample of rows. A frequent
    key is one bound, so there may be fewer chunks, and its own is as large as it is frequent.
    """
    keyed = source.where(~any_null(keys)).select(*cols(keys))
    dtype = source.schema[keys[0]].dataType
    number = ordinal_of(keys[0], dtype) if len(keys) == 1 else None
    if number is None:
        places = sampled_bounds(keyed, keys, chunks).orderBy(*cols(keys))
        found = places.select(*[col(k).cast("string") for k in keys]).collect()
        # The first place is the smallest sampled key, which bounds nothing.
        return [tuple(r) for r in found][1:]
    points = [k / chunks for k in range(1, chunks)]
    if not points:
        return []
    kind, value = number
    sketch = keyed.agg(F.call_function(f"kll_sketch_agg_{kind}", value, F.lit(SKETCH_K)).alias("s"))
    filled = F.call_function(f"kll_sketch_get_n_{kind}", F.col("s")) > 0
    at = F.call_function(f"kll_sketch_get_quantile_{kind}", F.col("s"), F.array(*map(F.lit, points)))
    rows = sketch.where(filled).select(F.explode(F.array_distinct(at)).alias("q"))
    # Ascending as numbers; texts would sort otherwise.
    return [(r["t"],) for r in rows.orderBy("q").select(value_of(F.col("q"), dtype).alias("t")).collect()]


@dataclass(frozen=True)
class ChunkedCopy:
    """A copy below ``base``: ``plan/``, ``rows/`` by chunk, and the ledger ``done/`` by chunk."""

    spark: SparkSession
    base: str
    key: str | Sequence[str]
    chunks: int = 256
    per_wave: int = 16

    def __post_init__(self) -> None:
        if self.chunks < 1 or self.per_wave < 1:
            raise ValueError("chunks and per_wave must be at least 1")

    @property
    def keys(self) -> list[str]:
        return as_list(self.key)

    def bounds(self, source: DataFrame) -> list[tuple[str, ...]]:
        """Of the stored plan; the first call makes it. Later rows fall into its ranges, which are open at both ends."""
        path = f"{self.base}/plan"
        schema = "place int, parts array<string>"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            require_columns(source.columns, self.keys, "source")
            found = equal_bounds(source, self.keys, self.chunks)
            rows = [(i, list(b)) for i, b in enumerate(found)]
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
        stored = self.spark.read.schema(schema).parquet(path).orderBy("place").collect()
        return [tuple(r["parts"]) for r in stored]

    def done(self) -> DataFrame:
        """The ledger: ``(chunk, row_count, d0 .. d3)`` of the finished chunks."""
        digest = ", ".join(f"{p} long" for p in PARTS)
        schema = f"row_count long, {digest}, chunk int"
        if not path_exists(self.spark, f"{self.base}/done"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.base}/done")

    def missing(self, source: DataFrame) -> list[int]:
        """Chunks without an entry, ascending; the one of NULL keys comes first."""
        finished = {r["chunk"] for r in self.done().select("chunk").collect()}
        return [i for i in range(NO_KEY, len(self.bounds(source)) + 1) if i not in finished]

    def _filter(self, source: DataFrame, chunks: Sequence[int], bounds: list[tuple[str, ...]]) -> Column:
        ends: list[Bound] = [None, *bounds, None]
        keyed = [(ends[i], ends[i + 1]) for i in chunks if i != NO_KEY]
        test = within(self.keys, types_of(source, self.keys), keyed) & ~any_null(self.keys)
        return test | any_null(self.keys) if NO_KEY in chunks else test

    def _numbered(self, source: DataFrame, chunks: Sequence[int], bounds: list[tuple[str, ...]]) -> DataFrame:
        """Rows of some neighbouring or scattered chunks, with their chunk; other rows aren't read."""
        own = sorted({b for i in chunks if i != NO_KEY for b in (i - 1, i) if 0 <= b < len(bounds)})
        # Among the bounds that matter: how many lie at or below the key, and which chunk that is.
        place = range_of(self.keys, types_of(source, self.keys), [bounds[b] for b in own])
        chunk_at = F.array(*[F.lit(b) for b in [*own, len(bounds)]])
        # Range j of the chosen bounds ends at bound own[j], so it is the chunk of that number.
        number = F.when(any_null(self.keys), F.lit(NO_KEY)).otherwise(F.element_at(chunk_at, place + 1))
        return source.where(self._filter(source, chunks, bounds)).withColumn(CHUNK, number)

    def _digests(self, numbered: DataFrame, columns: Sequence[str]) -> DataFrame:
        sums = [F.coalesce(F.sum(h), F.lit(0)).alias(p) for h, p in zip(row_hashes(columns), PARTS, strict=True)]
        return numbered.groupBy(F.col(CHUNK).alias("chunk")).agg(F.count(F.lit(1)).alias("row_count"), *sums)

    def run(self, source: DataFrame, max_waves: int | None = None, only: Sequence[int] | None = None) -> int:
        """Copy the chunks that are missing (or ``only`` some), a wave at a time; how many were.

        A wave is one job over ``per_wave`` chunks. Its rows are written, read back for their digests, and
        entered; a failure loses at most the wave it hits. ``max_waves`` ends a run early, as a time limit would.
        """
        bounds = self.bounds(source)
        todo = self.missing(source) if only is None else list(only)
        waves = [todo[i : i + self.per_wave] for i in range(0, len(todo), self.per_wave)]
        copied = 0
        for wave in waves[:max_waves]:
            (
                self._numbered(source, wave, bounds)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(CHUNK).parquet(f"{self.base}/rows")
            )
            found = self._digests(self._stored(source.schema, wave), source.columns)
            # A chunk may be empty: it is entered all the same.
            every = self.spark.createDataFrame([(i,) for i in wave], "chunk int")
            zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("row_count", *PARTS)]
            (
                every.join(found, "chunk", "left").select("chunk", *zero).coalesce(1)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("chunk").parquet(f"{self.base}/done")
            )
            copied += len(wave)
        return copied

    def _stored(self, schema: T.StructType, chunks: Sequence[int]) -> DataFrame:
        """Rows as written, of some chunks; folders of others aren't listed as input."""
        if not path_exists(self.spark, f"{self.base}/rows"):
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(CHUNK, T.IntegerType())]))
        stored = T.StructType([*schema.fields, T.StructField(CHUNK, T.IntegerType())])
        rows = self.spark.read.schema(stored).parquet(f"{self.base}/rows")
        return rows.where(F.col(CHUNK).isin(list(chunks)))

    def read(self, schema: T.StructType) -> DataFrame:
        """The rows of finished chunks."""
        finished = [r["chunk"] for r in self.done().where("row_count > 0").select("chunk").collect()]
        return self._stored(schema, finished).select(*cols(schema.names))

    def stale(self, source: DataFrame) -> list[int]:
        """Finished chunks whose rows in the source are others now: one scan, one digest per chunk."""
        bounds = self.bounds(source)
        entries = {r["chunk"]: tuple(r[c] for c in ("row_count", *PARTS)) for r in self.done().collect()}
        if not entries:
            return []
        numbered = self._numbered(source, sorted(entries), bounds)
        now = {r["chunk"]: tuple(r[c] for c in ("row_count", *PARTS)) for r in self._digests(numbered, source.columns).collect()}
        nothing = (0,) * (1 + len(PARTS))
        return sorted(i for i, entry in entries.items() if now.get(i, nothing) != entry)

    def refresh(self, source: DataFrame) -> int:
        """Copy what is missing, then again what has changed since it was copied; how many chunks were.

        A changed chunk's entry is withdrawn by being written anew; one that became empty is emptied.
        """
        copied = self.run(source)
        changed = self.stale(source)
        for i in changed:
            _remove(self.spark, f"{self.base}/done/chunk={i}")
            _remove(self.spark, f"{self.base}/rows/{CHUNK}={i}")
        return copied + (self.run(source, only=changed) if changed else 0)


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
