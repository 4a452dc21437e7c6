"""Registered queries: scans, sources and sinks, predicates, incremental extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import incremental as inc
from tidemark.operators.merge import merge
from tidemark.operators.reconcile import side_by_side
from tidemark.operators.stage import stage
from tidemark.plans.fixtures import CUTOFF
from tidemark.plans.models import dim_stock_master, materialize
from tidemark.plans.chunked_copy import ChunkedCopy
from tidemark.plans.registry import Tables, query
from tidemark.plans.sync import fan_out, fan_out_counts, full_load
from tidemark.session import work_dir
from tidemark.sources.scan import chunk_by_key, chunk_stats, scan, scan_count, scan_sql
from tidemark.sources.text import read_csv_text, to_ndjson, write_csv, write_ndjson
from tidemark.sources.versions import VersionedTable
from tidemark.spec import TargetSpec

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("scan_full", "SELECT * FROM orders")
def scan_full(t: Tables) -> DataFrame:
    return scan(t.spark, f"{t.sf_dir}/orders.parquet")


@query(
    "scan_projected",
    "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F'",
)
def scan_projected(t: Tables) -> DataFrame:
    return scan(
        t.spark,
        f"{t.sf_dir}/orders.parquet",
        columns=["o_orderkey", "o_totalprice", "o_orderdate"],
        where="o_orderstatus = 'F'",
        order_by="o_orderdate",
    )


@query("scan_count", "SELECT count(*) AS row_count FROM orders WHERE o_orderstatus = 'F'")
def count_rows(t: Tables) -> DataFrame:
    return scan_count(t.spark, f"{t.sf_dir}/orders.parquet", "o_orderstatus = 'F'")


@query(
    "scan_custom_sql",
    """SELECT c.c_mktsegment AS segment, count(*) AS order_count,
              max(o.o_orderdate) AS last_order
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       WHERE o.o_orderstatus = 'O' GROUP BY c.c_mktsegment""",
)
def custom_sql(t: Tables) -> DataFrame:
    return scan_sql(
        t.spark,
        """SELECT c.c_mktsegment AS segment, count(*) AS order_count,
                  max(o.o_orderdate) AS last_order
           FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
           WHERE o.o_orderstatus = :status GROUP BY c.c_mktsegment""",
        {"orders": t.orders, "customer": t.customer},
        {"status": "O"},
    )


@query(
    "scan_chunked",
    """WITH bounds AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
       SELECT CAST(((o_orderkey - lo)::HUGEINT * 16) // (hi - lo + 1) AS BIGINT) AS chunk,
              count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
       FROM orders, bounds GROUP BY 1""",
)
def scan_chunked(t: Tables) -> DataFrame:
    return chunk_stats(chunk_by_key(t.orders, "o_orderkey", 16), "o_orderkey")


@query("copy_resumed", "SELECT * FROM lineitem")
def copy_resumed(t: Tables) -> DataFrame:
    """A copy in chunks that stops after two waves and goes on in another run."""
    source, path = t.lineitem, work_dir(t.spark, "copy")
    for waves in (2, None):
        copy = ChunkedCopy(
            t.spark, path, ("l_orderkey", "l_linenumber"), chunks=24, per_wave=6
        )
        copy.run(source, waves)
    return copy.read(source.schema)


@query(
    "copy_chunk_sizes",
    """SELECT 32 AS chunks, (SELECT count(*) FROM events) AS row_count, true AS balanced""",
)
def copy_chunk_sizes(t: Tables) -> DataFrame:
    """Chunks of a key whose values are unevenly spread: the square of the id."""
    source = t.events.withColumn("key", F.col("event_id") * F.col("event_id"))
    copy = ChunkedCopy(t.spark, work_dir(t.spark, "copy"), "key", chunks=32, per_wave=64)
    copy.run(source)
    sizes = copy.done().where("row_count > 0")
    even = F.max(F.abs(F.col("row_count") * 32 / F.lit(source.count()) - 1)) < 0.25
    return sizes.agg(
        F.count(F.lit(1)).cast("int").alias("chunks"), F.sum("row_count").alias("row_count"), even.alias("balanced")
    )


@query("copy_refreshed", "SELECT * FROM orders_drift", uses=("orders_drift",))
def copy_refreshed(t: Tables) -> DataFrame:
    """A finished copy of another state: only chunks whose digests differ are copied again."""
    copy = ChunkedCopy(t.spark, work_dir(t.spark, "copy"), "o_orderkey", chunks=40, per_wave=20)
    copy.run(t.orders)
    copy.refresh(t.orders_drift)
    return copy.read(t.orders.schema)


@query(
    "csv_round_trip",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, nullif(raw_int, '') AS raw_int,
              nullif(raw_bool, '') AS raw_bool, nullif(raw_date, '') AS raw_date, raw_text
       FROM dirty""",
    uses=("dirty",),
)
def csv_round_trip(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "csv")
    dirty = t.dirty
    write_csv(dirty, path)
    order = ["raw_date", "raw_bool", "raw_int", "event_id", "raw_text"]
    return read_csv_text(t.spark, path, order, file_columns=dirty.columns, multi_line=True)


@query(
    "ndjson_export",
    """SELECT '{"ticker":"' || ticker || '","country_code":'
              || coalesce('"' || country_code || '"', 'null')
              || ',"name_local":' || CAST(to_json(name_local) AS VARCHAR) || '}' AS line
       FROM (SELECT * FROM stock_master ORDER BY ticker LIMIT 10000)""",
    uses=("stock_master",),
)
def ndjson_export(t: Tables) -> DataFrame:
    rows = t.stock_master.select("ticker", "country_code", "name_local")
    return to_ndjson(rows, 10_000, "ticker")


@query(
    "ndjson_full_export",
    """SELECT CAST(ticker AS VARCHAR) AS ticker, country_code, name_local FROM stock_master""",
    uses=("stock_master",),
)
def ndjson_full_export(t: Tables) -> DataFrame:
    """All rows written as NDJSON and read back."""
    rows = t.stock_master.select(F.col("ticker").cast("string"), "country_code", "name_local")
    path = work_dir(t.spark, "ndjson")
    write_ndjson(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "stage_table",
    """SELECT count(*) AS source_rows, count(*) AS staged_rows, true AS is_complete
       FROM stage_dup""",
    uses=("stage_dup",),
)
def stage_table(t: Tables) -> DataFrame:
    """Stage a delta, then compare what was counted while writing with both sides."""
    staged = stage(t.spark, t.stage_dup)
    source = t.stage_dup.agg(F.count(F.lit(1)).alias("source_rows"))
    written = staged.rows.agg(F.count(F.lit(1)).alias("staged_rows"))
    complete = (F.col("source_rows") == F.col("staged_rows")) & (
        F.col("staged_rows") == F.lit(staged.row_count)
    )
    return side_by_side(source, written).withColumn("is_complete", complete)


@query("full_load_overwrite", "SELECT * FROM orders")
def full_load_overwrite(t: Tables) -> DataFrame:
    table = VersionedTable(t.spark, work_dir(t.spark, "orders"))
    full_load(table, t.orders_tgt)
    full_load(table, t.orders)
    return table.read()


FAN_OUT = [
    TargetSpec("everything", "full_copy"),
    TargetSpec("finished", "full_copy", "o_orderstatus = 'F'"),
    TargetSpec("recent", "full_copy", f"o_orderdate >= TIMESTAMP_NTZ '{CUTOFF}'"),
]

FAN_OUT_SQL = f"""
    SELECT 'everything' AS target, count(*) AS row_count FROM orders
    UNION ALL SELECT 'finished', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'recent', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'"""


@query("multi_target_fanout", FAN_OUT_SQL)
def multi_target_fanout(t: Tables) -> DataFrame:
    return fan_out(t.spark, t.orders, FAN_OUT, work_dir(t.spark, "fanout"))


@query("multi_target_counts", FAN_OUT_SQL)
def multi_target_counts(t: Tables) -> DataFrame:
    return fan_out_counts(t.orders, FAN_OUT)


@query(
    "model_materialize",
    """SELECT ticker, is_valid_code FROM (
         SELECT ticker, code IS NOT NULL AND length(code) > 0 AS is_valid_code
         FROM stock_master)""",
    uses=("stock_master",),
)
def model_materialize(t: Tables) -> DataFrame:
    location = work_dir(t.spark, "schema")
    custom = location.rsplit("-", 1)[-1]
    table = materialize(
        t.spark, dim_stock_master(t.stock_master), "dim_stock", "analytics", custom, location
    )
    return t.spark.table(table).select("ticker", "is_valid_code")


@query(
    "where_custom",
    "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000",
)
def where_custom(t: Tables) -> DataFrame:
    custom = "o_orderpriority = '1-URGENT' AND o_totalprice > 1000"
    return t.orders.where(inc.predicate(custom))


@query(
    "where_combined",
    """SELECT * FROM orders
       WHERE (o_orderpriority = '1-URGENT' OR o_orderstatus = 'O')
         AND o_orderdate > (SELECT max(o_orderdate) FROM orders_hwm_tgt)
         AND o_totalprice > 1000""",
    uses=("orders_hwm_tgt",),
)
def where_combined(t: Tables) -> DataFrame:
    orders = t.orders
    hwm = inc.watermark_value(t.orders_hwm_tgt, "o_orderdate")
    return orders.where(
        inc.predicate(
            custom="o_orderpriority = '1-URGENT' OR o_orderstatus = 'O'",
            base="o_totalprice > 1000",
            incremental=inc.incremental_filter(orders, "o_orderdate", "timestamp", hwm),
            combine="and",
        )
    )


@query(
    "where_precedence",
    "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000",
)
def where_precedence(t: Tables) -> DataFrame:
    """A custom filter replaces the incremental one."""
    orders = t.orders
    hwm = inc.watermark_value(t.orders_hwm_tgt, "o_orderdate")
    beyond = inc.incremental_filter(orders, "o_orderdate", "timestamp", hwm)
    return orders.where(
        inc.predicate("o_orderpriority = '1-URGENT'", "o_totalprice > 1000", beyond)
    )


@query(
    "where_split_in",
    """SELECT * FROM cust_ticker
       WHERE split_part(ticker_exchange, '-', 2) IN ('BUILDING', 'MACHINERY', '')""",
    uses=("cust_ticker",),
)
def where_split_in(t: Tables) -> DataFrame:
    wanted = ["BUILDING", "MACHINERY", ""]
    return t.cust_ticker.where(inc.split_part_in("ticker_exchange", "-", 2, wanted))


@query(
    "where_like_not_in",
    """SELECT ticker, country_code, curr FROM stock_master
       WHERE ticker LIKE '%1' AND country_code NOT IN ('US', 'KR') AND curr = 'USD'""",
    uses=("stock_master",),
)
def where_like_not_in(t: Tables) -> DataFrame:
    listed = inc.like_not_in("ticker", "%1", "country_code", ["US", "KR"])
    return t.stock_master.where(listed & (F.col("curr") == "USD")).select(
        "ticker", "country_code", "curr"
    )


@query(
    "watermark_lookup",
    "SELECT max(o_orderdate) AS hwm FROM orders_hwm_tgt",
    uses=("orders_hwm_tgt",),
)
def watermark_lookup(t: Tables) -> DataFrame:
    return inc.watermark(t.orders_hwm_tgt, "o_orderdate")


@query(
    "incremental_timestamp",
    "SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders_hwm_tgt)",
    uses=("orders_hwm_tgt",),
)
def incremental_timestamp(t: Tables) -> DataFrame:
    hwm = inc.watermark_value(t.orders_hwm_tgt, "o_orderdate")
    return inc.incremental(t.orders, "o_orderdate", "timestamp", hwm)


@query(
    "incremental_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
       WHERE CAST(o_orderdate AS DATE)
             >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders_hwm_tgt)""",
    uses=("orders_hwm_tgt",),
)
def incremental_date(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date").alias("order_day")
    hwm = inc.watermark_value(t.orders_hwm_tgt.select(day), "order_day")
    return inc.incremental(t.orders.select("o_orderkey", day), "order_day", "date", hwm)


@query(
    "incremental_yyyymmdd",
    f"""SELECT * FROM orders_ymd
        WHERE changed >= (SELECT max(changed) FROM orders_ymd
                          WHERE o_orderdate < TIMESTAMP '{CUTOFF}')""",
    uses=("orders_ymd",),
)
def incremental_yyyymmdd(t: Tables) -> DataFrame:
    loaded = t.orders_ymd.where(f"o_orderdate < TIMESTAMP_NTZ '{CUTOFF}'")
    hwm = inc.watermark_value(loaded, "changed")
    return inc.incremental(t.orders_ymd, "changed", "yyyymmdd", hwm)


@query(
    "incremental_first_run",
    "SELECT * FROM orders",
)
def incremental_first_run(t: Tables) -> DataFrame:
    """An empty target has no watermark: the whole source, ordered by the field."""
    hwm = inc.watermark_value(t.orders.where("false"), "o_orderdate")
    return inc.incremental(t.orders, "o_orderdate", "timestamp", hwm).orderBy("o_orderdate", "o_orderkey")


MIDDLE_VERSION = "SELECT (min(version) + max(version)) // 2 FROM orders_ymd"


@query(
    "incremental_version",
    f"""SELECT *, version AS source_version FROM orders_ymd
        WHERE version > ({MIDDLE_VERSION}) AND o_orderstatus <> 'P'""",
    uses=("orders_ymd",),
)
def incremental_version(t: Tables) -> DataFrame:
    orders = t.orders_ymd
    last = orders.agg(F.expr("(min(version) + max(version)) div 2")).first()[0]
    return inc.incremental_version(orders, "version", last, custom="o_orderstatus <> 'P'")


@query(
    "incremental_version_mode",
    """SELECT max(version) AS last_version, max(version) - min(version) AS version_range,
              CASE WHEN max(version) - min(version) >= 2000000000 THEN 'full_sync'
                   ELSE 'incremental_version' END AS mode
       FROM orders_ymd""",
    uses=("orders_ymd",),
)
def incremental_version_mode(t: Tables) -> DataFrame:
    return inc.version_mode(t.orders_ymd, "version", limit=2_000_000_000)


@query(
    "incremental_overlap",
    f""", staged AS (
          SELECT * FROM orders WHERE o_orderdate >
            (SELECT max(o_orderdate) FROM orders_hwm_tgt) - INTERVAL '2' DAY)
        SELECT {ORDERS} FROM orders_hwm_tgt
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM staged)
        UNION ALL SELECT {ORDERS} FROM staged""",
    uses=("orders_hwm_tgt",),
)
def incremental_overlap(t: Tables) -> DataFrame:
    target = t.orders_hwm_tgt
    hwm = inc.watermark_value(target, "o_orderdate")
    late = inc.incremental(t.orders, "o_orderdate", "timestamp", hwm, lag="2 days")
    return merge(target, late, "o_orderkey", "upsert")
