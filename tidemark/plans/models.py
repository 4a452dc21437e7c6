"""Models: plain functions from source tables to a model table.

A model on a model is a function call, so a chain is one plan for Catalyst and nothing is
written in between unless :func:`materialize` is asked to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import check_identifier, col, quote
from tidemark.operators.stage import staged

# Country codes with a name of their own, price classes from the highest.
COUNTRY_NAMES = {"US": "미국", "KR": "한국", "JP": "일본", "CN": "중국"}
OTHER_COUNTRY = "기타"
PRICE_CLASSES = [(100, "고가주"), (50, "중가주")]
LOWEST_PRICE_CLASS = "저가주"
COUNTRY_NAME_COLUMN = "국가명"
PRICE_CLASS_COLUMN = "가격대분류"


@dataclass(frozen=True)
class StockColumns:
    """Which source columns hold what the dimension derives from."""

    code: str = "code"
    exchange: str = "exchange"
    country: str = "country_code"
    price: str = "close_price"


def filled(c: Column) -> Column:
    """Neither NULL nor empty; never NULL itself."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def dim_stock_master(source: DataFrame, names: StockColumns = StockColumns()) -> DataFrame:
    """The securities master with validity flags, country name and price class.

    A NULL price is invalid and falls into the lowest class.
    """
    country, price = col(names.country), col(names.price)
    country_name = F.lit(None).cast("string")
    for code, name in COUNTRY_NAMES.items():
        country_name = F.when(country == code, name).otherwise(country_name)
    price_class = F.lit(LOWEST_PRICE_CLASS)
    for floor, name in reversed(PRICE_CLASSES):
        price_class = F.when(price >= floor, name).otherwise(price_class)
    return source.withColumns(
        {
            "is_valid_code": filled(col(names.code)),
            "is_valid_exchange": filled(col(names.exchange)),
            "is_valid_price": F.coalesce(price > 0, F.lit(False)),
            COUNTRY_NAME_COLUMN: F.coalesce(country_name, F.lit(OTHER_COUNTRY)),
            PRICE_CLASS_COLUMN: price_class,
        }
    )


def first_model(dimension: DataFrame, id_column: str, valid: Column) -> DataFrame:
    """Valid rows, and after them the invalid ones with their id blanked out."""
    blank = F.lit(None).cast(dimension.schema[id_column].dataType)
    return dimension.where(valid).unionByName(
        dimension.where(~valid).withColumn(id_column, blank)
    )


def second_model(first: DataFrame, id_column: str, wanted: Column | None = None) -> DataFrame:
    """A model on :func:`first_model`: rows that have an id, or the ``wanted`` ones."""
    return first.where(col(id_column).isNotNull() if wanted is None else wanted)


def model_schema(default: str, custom: str | None = None) -> str:
    """Where a model is stored: the default schema, or ``<default>_<custom>``."""
    return default if custom is None else f"{default}_{custom.strip()}"


def materialize(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    default: str,
    custom: str | None = None,
    location: str | None = None,
) -> str:
    """Save a model as a table (replacing it) and return its qualified name.

    ``location`` is the folder of the schema, by default one in the warehouse. The rows are
    made and staged first, so a model that fails leaves the old table as it was; ``df`` may read
    the table it replaces.
    """
    schema = check_identifier(model_schema(default, custom))
    check_identifier(name)
    create = f"CREATE SCHEMA IF NOT EXISTS {quote(schema)}"
    path = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"{create} LOCATION '{path}'" if location else create)
    table = f"{quote(schema)}.{quote(name)}"
    with staged(spark, df) as stage:
        writer = stage.rows.write.mode("overwrite")
        if location:
            writer = writer.option("path", f"{location}/{name}")
        writer.saveAsTable(table)
    return table
