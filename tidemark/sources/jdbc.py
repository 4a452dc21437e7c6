"""JDBC tables as source or sink: option building around ``format("jdbc")``."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.names import check_identifier


@dataclass(frozen=True)
class JdbcTable:
    """A table (or parenthesised query) behind a JDBC URL.

    With ``partition_column`` the read is split into ``num_partitions`` key ranges that
    executors fetch in parallel; without it a single task reads everything, so give one
    for anything large. Credentials come from the caller and are never logged.
    """

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    partition_column: str | None = None
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int | None = None
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def __post_init__(self) -> None:
        parts = (
            self.partition_column,
            self.lower_bound,
            self.upper_bound,
            self.num_partitions,
        )
        given = [p is not None for p in parts]
        if any(given) and not all(given):
            raise ValueError(
                "partition_column, lower_bound, upper_bound and num_partitions go together"
            )
        if self.num_partitions is not None and self.num_partitions < 1:
            raise ValueError("num_partitions must be at least 1")

    def _common(self) -> dict[str, str]:
        options = {"url": self.url, "dbtable": self.table, "driver": self.driver}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return options

    def read_options(self) -> dict[str, str]:
        options = self._common() | {
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
        }
        if self.partition_column is not None:
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.num_partitions),
            }
        return options

    def write_options(self) -> dict[str, str]:
        return self._common() | {"batchsize": str(self.batch_size)}

    def bounds_query(self, column: str) -> "JdbcTable":
        """A one-row table with the lowest and highest value of ``column``."""
        inner = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {self.table} t) bounds"
        return replace(self, table=inner)

    def partitioned(self, spark: SparkSession, column: str, n: int) -> "JdbcTable":
        """The same table, to be read as ``n`` key ranges; asks the source for the bounds."""
        lo, hi = self.bounds_query(check_identifier(column)).read(spark).first()
        if lo is None:
            return self
        return replace(
            self, partition_column=column, lower_bound=lo, upper_bound=hi, num_partitions=n
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options()).load()

    def write(self, df: DataFrame, mode: str = "append") -> None:
        """Write ``df``. ``overwrite`` truncates rather than drops, keeping the table's grants."""
        writer = df.write.format("jdbc").options(**self.write_options())
        writer.option("truncate", "true").mode(mode).save()
