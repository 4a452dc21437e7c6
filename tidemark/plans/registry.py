"""The registered queries: each a Spark plan, with the same question in SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.fixtures import duckdb_with, load

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Base and derived tables of one data folder by attribute, loaded lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register ``fn(tables) -> DataFrame``; ``uses`` names derived tables the SQL reads.

    SQL that defines further common tables starts with ``, name AS (...)``.
    """

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__doc__ = fn.__doc__
        run.__name__ = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"{duckdb_with(*uses)}\n{sql}" if uses else sql
        return run

    return register
