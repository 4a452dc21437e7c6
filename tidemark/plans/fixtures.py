"""Derived inputs of the registered queries, written once for Spark and DuckDB.

Each is SQL that both engines run unchanged, apart from ``{YMD:x}`` (a day as yyyymmdd
text). Derived tables read whole base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

CUTOFF = "2000-01-01 00:00:00"

RECIPES = {
    # A stale target: keys missing, prices out of date, keys the source no longer has.
    "orders_tgt": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice - 100
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders WHERE o_orderkey % 5 <> 0
        UNION ALL
        SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               o_orderpriority
        FROM orders WHERE o_orderkey % 50 = 1""",
    # A copy that went wrong in two stretches of its keys: wrong prices, lost and extra rows.
    "orders_drift": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey BETWEEN 1000 AND 1100 THEN o_totalprice + 1
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders WHERE o_orderkey NOT BETWEEN 700 AND 720
        UNION ALL
        SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               o_orderpriority
        FROM orders WHERE o_orderkey BETWEEN 1 AND 10""",
    # Documents as text: nested, with values of several types at one path, broken ones, none.
    "orders_json": """
        SELECT o_orderkey, CASE o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN chr(123) || 'broken' WHEN 2 THEN '[]'
          ELSE chr(123) || '"id": ' || CAST(o_orderkey AS STRING) || ', "customer": ' || chr(123) || '"key": ' ||
            CASE WHEN o_orderkey % 5 = 0 THEN '"' || CAST(o_custkey AS STRING) || '"'
                 ELSE CAST(o_custkey AS STRING) END ||
            ', "vip": ' || CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'null' ELSE '"no"' END ||
            chr(125) || ', "tags": [' || CASE WHEN o_orderkey % 2 = 0 THEN '"a", 1, ' || chr(123) || '"deep": [2.5]' || chr(125) ELSE '"b"' END ||
            '], "status": "' || o_orderstatus || '"' || chr(125) END AS doc
        FROM orders""",
    # A target loaded up to a cut-off date.
    "orders_hwm_tgt": f"""
        SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}'""",
    # A yyyymmdd text field and a monotone row version.
    "orders_ymd": """
        SELECT *, {YMD:o_orderdate} AS changed, o_orderkey * 3 AS version FROM orders""",
    # A staged delta in which some keys occur twice, the later one being right.
    "stage_dup": f"""
        SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1,
               o_orderdate + INTERVAL '1' DAY, o_orderpriority
        FROM orders
        WHERE o_orderdate >= TIMESTAMP '{CUTOFF}' AND o_orderkey % 11 = 0""",
    # Text as it arrives from files.
    "dirty": """
        SELECT event_id,
          CASE event_id % 12
            WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN 'nan' WHEN 3 THEN 'None'
            WHEN 4 THEN 'NULL' WHEN 5 THEN 'null'
            WHEN 6 THEN CAST(event_id AS STRING) || '.0'
            WHEN 7 THEN '-' || CAST(event_id AS STRING) || '.9'
            WHEN 8 THEN ' ' || CAST(event_id AS STRING) || ' '
            WHEN 9 THEN 'ab.c' WHEN 10 THEN '00' || CAST(event_id AS STRING)
            ELSE CAST(event_id AS STRING) END AS raw_int,
          CASE event_id % 10
            WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN ' Yes ' WHEN 3 THEN 'ON'
            WHEN 4 THEN 'false' WHEN 5 THEN '0' WHEN 6 THEN 'no' WHEN 7 THEN 'off'
            WHEN 8 THEN 'maybe' ELSE '' END AS raw_bool,
          CASE event_id % 6
            WHEN 0 THEN {YMD:ts} WHEN 1 THEN '20251399' WHEN 2 THEN '18991231'
            WHEN 3 THEN '' WHEN 4 THEN 'NA' ELSE '2024-01-05' END AS raw_date,
          event_type AS raw_text
        FROM events""",
    # Dates in several formats, impossible ones, and numbers, as text.
    "dirty_dates": """
        SELECT event_id, d,
          CASE event_id % 8 WHEN 0 THEN d WHEN 1 THEN y || '-' || m || '-' || dd
            WHEN 2 THEN dd || '/' || m || '/' || y WHEN 3 THEN dd || '.' || m || '.' || y
            WHEN 4 THEN ' ' || dd || '/' || m || '/' || y || ' ' WHEN 5 THEN 'null'
            WHEN 6 THEN y || '/' || m || '/' || dd ELSE '31/02/' || y END AS mixed,
          CASE event_id % 5 WHEN 0 THEN '' ELSE m || '/' || dd || '/' || y END AS american,
          CASE event_id % 4 WHEN 0 THEN '1.5e3' ELSE CAST(event_id AS STRING) END AS amount,
          CASE event_id % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'off' ELSE 'TRUE' END AS flag
        FROM (SELECT event_id, {YMD:ts} AS d, substr({YMD:ts}, 1, 4) AS y, substr({YMD:ts}, 5, 2) AS m,
                     substr({YMD:ts}, 7, 2) AS dd FROM events) AS e""",
    # A securities master: NULL and empty keys, countries, NULL and zero prices.
    "stock_master": """
        SELECT
          CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN ''
            ELSE 'P' || CAST(p_partkey AS STRING) END AS code,
          CASE p_partkey % 19 WHEN 0 THEN NULL WHEN 1 THEN ''
            ELSE 'X' || CAST(p_size % 4 AS STRING) END AS exchange,
          p_brand AS gts_exnm, 'T' || CAST(p_partkey AS STRING) AS ticker,
          CASE p_partkey % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'KR' WHEN 2 THEN 'JP'
            WHEN 3 THEN 'CN' WHEN 4 THEN 'VN' ELSE NULL END AS country_code,
          'ISIN' || CAST(p_partkey AS STRING) AS isin, p_name AS name_local,
          p_name AS name_en, '20250812' AS as_of,
          CASE p_partkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 0e0
            ELSE CAST(p_size AS DOUBLE) * 3e0 END AS close_price,
          'USD' AS curr
        FROM part""",
    # The next day's load: changed, removed and new rows.
    "stock_master_v2": """
        SELECT code, exchange, gts_exnm, ticker, country_code, isin, name_local, name_en,
               '20250813' AS as_of,
               CASE WHEN LENGTH(ticker) % 2 = 0 THEN close_price + 1e0
                    ELSE close_price END AS close_price, curr
        FROM stock_master WHERE ticker NOT LIKE '%7'
        UNION ALL
        SELECT 'N' || ticker, 'X9', gts_exnm, 'N' || ticker, country_code, isin, name_local,
               name_en, '20250813', 10e0, curr
        FROM stock_master WHERE ticker LIKE '%3'""",
    # Pipeline runs.
    "run_log": """
        SELECT event_id AS run_id, event_type AS pipeline,
          CASE WHEN event_id % 9 = 0 THEN 'failed' WHEN event_id % 10 = 3 THEN 'running'
            ELSE 'completed' END AS status,
          ts AS started_at, value AS duration_s, event_id % 97 AS rows_copied,
          user_id % 4 AS error_count, CAST(event_id % 53 AS DOUBLE) * 40e0 AS memory_mb
        FROM events""",
    # CODE-EXCHANGE text, some without the second part.
    "cust_ticker": """
        SELECT c_custkey,
               'C' || CAST(c_custkey AS STRING) ||
               CASE WHEN c_custkey % 8 = 0 THEN '' ELSE '-' || c_mktsegment END
                 AS ticker_exchange,
               c_acctbal
        FROM customer""",
}

_YMD = re.compile(r"\{YMD:(\w+)\}")


def spark_recipe(name: str) -> str:
    return _YMD.sub(r"date_format(\1, 'yyyyMMdd')", RECIPES[name])


def duckdb_recipe(name: str) -> str:
    return _YMD.sub(r"strftime(\1, '%Y%m%d')", RECIPES[name])


def _inputs(sql: str) -> list[str]:
    words = set(re.findall(r"\bFROM\s+(\w+)", sql))
    return [n for n in (*BASE_TABLES, *RECIPES) if n in words]


# Schemas by path: inferring one reads file footers in a job of its own.
_schemas: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a derived one, lazily."""
    if name in BASE_TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = spark.read.parquet(path).schema
        return spark.read.schema(_schemas[path]).parquet(path)
    sql = spark_recipe(name)
    inputs = _inputs(sql)
    for n in inputs:
        sql = re.sub(rf"\bFROM\s+{n}\b", f"FROM {{{n}}}", sql)
    return spark.sql(sql, **{n: load(spark, sf_dir, n) for n in inputs})


def duckdb_with(*names: str) -> str:
    """A WITH clause that defines derived tables, and what they derive from, for DuckDB."""
    needed: list[str] = []

    def add(name: str) -> None:
        for n in _inputs(duckdb_recipe(name)):
            if n in RECIPES:
                add(n)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_recipe(n)})" for n in needed)
