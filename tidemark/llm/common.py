"""Tables in the shared folder, and connected components by joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import work_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, a lost executor costs
    a re-read only. Lives as long as the cluster keeps its shared folder."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component_id)`` for every end of an edge; the component is its smallest id.

    Alternating large-star and small-star rounds: each round joins every node with the smallest
    of its neighbours, so a component becomes a star after about log(diameter) rounds. Minima
    are aggregated before the shuffle, no neighbourhood is gathered, and only a
    count and a checksum per round reach the driver. Loops and NULL ends are ignored.
    """
    e = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where("u > v and v is not null").distinct()
    e = saved(e, "edges")
    seen = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every larger neighbour is hung below the smallest one.
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u > v").distinct()
        # Small star: a node and its smaller neighbours are hung below the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").where("u > v").distinct()
        e = saved(small, "edges")
        now = e.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    tops = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(tops)


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (place in its group by ``order``, from 0) and ``group_size``.

    NULL sorts first and is a group of its own; rows that are alike in ``order`` stand in any order. Rows
    are dealt by ranges of (group, order, place of reading), so neither a large group nor equal rows meet in
    one task; each task's rows are numbered where they lie, and one row per task and group is shifted by
    what stands before it.
    """
    spark = rows.sparkSession
    tie, line, part = "__tie", "__line", "__part"
    by = [F.col(c).asc_nulls_first() for c in [*group, *order, tie]]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lined = saved(
        rows.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .drop(tie)
        .withColumn(line, F.monotonically_increasing_id()),
        "ranked",
    ).withColumn(part, F.shiftright(line, 33))
    runs = lined.groupBy(part, *group).agg(F.min(line).alias("__first"), F.count(F.lit(1)).alias("__n"))
    # At most one row per task and group.
    whole = Window.partitionBy(*group)
    runs = runs.select(
        *[F.col(c).alias(f"__{i}") for i, c in enumerate([part, *group])],
        "__first",
        F.coalesce(
            F.sum("__n").over(whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
        F.sum("__n").over(whole).alias("group_size"),
    )
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate([part, *group])]
    )
    return lined.join(runs, same).select(
        *rows.columns, (F.col(line) - F.col("__first") + F.col("__before")).alias("rank"), "group_size"
    )
