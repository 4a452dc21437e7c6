"""Registered queries: data tests, reconciliation, paged reads, run audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import ColumnSpec
from tidemark.operators import audit as A
from tidemark.operators import data_tests as D
from tidemark.operators import digests as G
from tidemark.operators import paging as P
from tidemark.operators import reconcile as R
from tidemark.operators.shape import quality_report as quality
from tidemark.plans.registry import Tables, query


@query(
    "test_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def unique(t: Tables) -> DataFrame:
    return D.test_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "test_not_null",
    """SELECT 'code' AS column_name, count(*) - count(code) AS failures FROM stock_master
       UNION ALL SELECT 'exchange', count(*) - count(exchange) FROM stock_master
       UNION ALL SELECT 'gts_exnm', count(*) - count(gts_exnm) FROM stock_master
       UNION ALL SELECT 'ticker', count(*) - count(ticker) FROM stock_master""",
    uses=("stock_master",),
)
def not_null(t: Tables) -> DataFrame:
    return D.test_not_null(t.stock_master, ["code", "exchange", "gts_exnm", "ticker"])


SUITE = [
    D.DataTest("orders", "o_orderkey", "unique"),
    D.DataTest("orders", "o_orderkey", "not_null"),
    D.DataTest("orders", "o_orderdate", "not_null"),
    D.DataTest("orders", "o_custkey", "relationship", "customer", "c_custkey"),
    D.DataTest("stock", "code", "not_null"),
    D.DataTest("stock", "code", "unique"),
    D.DataTest("stock", "ticker", "unique"),
]


@query(
    "test_suite",
    """, results AS (
         SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, 'unique' AS test,
                (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL
                 GROUP BY 1 HAVING count(*) > 1)) AS failures
         UNION ALL SELECT 'orders', 'o_orderkey', 'not_null',
                (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)
         UNION ALL SELECT 'orders', 'o_orderdate', 'not_null',
                (SELECT count(*) FROM orders WHERE o_orderdate IS NULL)
         UNION ALL SELECT 'orders', 'o_custkey', 'relationship',
                (SELECT count(DISTINCT o_custkey) FROM orders
                 WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
         UNION ALL SELECT 'stock', 'code', 'not_null',
                (SELECT count(*) FROM stock_master WHERE code IS NULL)
         UNION ALL SELECT 'stock', 'code', 'unique',
                (SELECT count(*) FROM (SELECT code FROM stock_master WHERE code IS NOT NULL
                 GROUP BY 1 HAVING count(*) > 1))
         UNION ALL SELECT 'stock', 'ticker', 'unique',
                (SELECT count(*) FROM (SELECT ticker FROM stock_master
                 GROUP BY 1 HAVING count(*) > 1)))
       SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM results""",
    uses=("stock_master",),
)
def suite(t: Tables) -> DataFrame:
    tables = {"orders": t.orders, "customer": t.customer, "stock": t.stock_master}
    return D.run_tests(tables, SUITE)


@query(
    "test_relationship",
    """SELECT l_partkey AS value, count(*) AS n FROM lineitem
       WHERE l_partkey IS NOT NULL AND NOT EXISTS (
         SELECT 1 FROM part WHERE p_partkey = l_partkey)
       GROUP BY 1""",
)
def relationship(t: Tables) -> DataFrame:
    return D.test_relationship(t.lineitem, "l_partkey", t.part, "p_partkey")


@query(
    "test_relationship_orphans",
    """SELECT o_orderkey AS value, count(*) AS n FROM orders_tgt
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = orders_tgt.o_orderkey)
       GROUP BY 1""",
    uses=("orders_tgt",),
)
def relationship_orphans(t: Tables) -> DataFrame:
    return D.test_relationship(t.orders_tgt, "o_orderkey", t.orders, "o_orderkey")


@query(
    "quality_report",
    """, counts AS (
         SELECT 'code' AS column_name, 'null_values' AS "check", 'warning' AS status,
                count(*) - count(code) AS n FROM stock_master
         UNION ALL SELECT 'exchange', 'null_values', 'warning', count(*) - count(exchange)
         FROM stock_master
         UNION ALL SELECT 'ticker', 'null_values', 'warning', count(*) - count(ticker)
         FROM stock_master
         UNION ALL SELECT 'close_price', 'null_values', 'warning',
                count(*) - count(close_price) FROM stock_master
         UNION ALL SELECT 'close_price', 'decimal_in_integer', 'error', count(close_price)
         FROM stock_master)
       SELECT * FROM counts WHERE n > 0""",
    uses=("stock_master",),
)
def quality_report(t: Tables) -> DataFrame:
    """The price is declared an integer here, but every price is written with a point."""
    shape = [
        ColumnSpec("code", "text"),
        ColumnSpec("exchange", "text"),
        ColumnSpec("ticker", "text"),
        ColumnSpec("close_price", "integer"),
    ]
    return quality(t.stock_master, shape)


@query(
    "reconcile_counts",
    """SELECT (SELECT count(*) FROM orders) AS source_count,
              (SELECT count(*) FROM orders_tgt) AS target_count,
              (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders_tgt) AS is_valid""",
    uses=("orders_tgt",),
)
def counts(t: Tables) -> DataFrame:
    return R.reconcile_counts(t.orders, t.orders_tgt)


def keys_sql(source: str, target: str) -> str:
    return f"""
        SELECT (SELECT count(*) FROM {source}) AS source_count,
               (SELECT count(*) FROM {target}) AS target_count,
               count(*) FILTER (t IS NULL) AS missing_in_target,
               count(*) FILTER (s IS NULL) AS extra_in_target,
               count(*) FILTER (t IS NULL OR s IS NULL) = 0 AS is_valid
        FROM (SELECT DISTINCT o_orderkey AS s FROM {source}) a
        FULL JOIN (SELECT DISTINCT o_orderkey AS t FROM {target}) b ON a.s = b.t"""


@query("reconcile_keys", keys_sql("orders", "orders_tgt"), uses=("orders_tgt",))
def reconcile_keys(t: Tables) -> DataFrame:
    return R.reconcile_keys(t.orders, t.orders_tgt, "o_orderkey")


@query(
    "reconcile_key_differences",
    """SELECT o_orderkey, 'missing_in_target' AS side
       FROM (SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM orders_tgt)
       UNION ALL
       SELECT o_orderkey, 'extra_in_target'
       FROM (SELECT o_orderkey FROM orders_tgt EXCEPT SELECT o_orderkey FROM orders)""",
    uses=("orders_tgt",),
)
def key_differences(t: Tables) -> DataFrame:
    return R.key_differences(t.orders, t.orders_tgt, "o_orderkey")


FINISHED = "(SELECT * FROM orders WHERE o_orderstatus = 'F')"


@query("reconcile_keys_filtered", keys_sql(FINISHED, "orders_tgt"), uses=("orders_tgt",))
def reconcile_keys_filtered(t: Tables) -> DataFrame:
    """The filter on the source only: the whole rest of the target counts as extra."""
    return R.reconcile_keys(
        t.orders, t.orders_tgt, "o_orderkey", "o_orderstatus = 'F'", filter_target=False
    )


@query(
    "reconcile_keys_filtered_both",
    keys_sql(FINISHED, "(SELECT * FROM orders_tgt WHERE o_orderstatus = 'F')"),
    uses=("orders_tgt",),
)
def reconcile_keys_filtered_both(t: Tables) -> DataFrame:
    return R.reconcile_keys(t.orders, t.orders_tgt, "o_orderkey", "o_orderstatus = 'F'")


@query(
    "reconcile_incremental",
    """, c AS (SELECT (SELECT count(*) FROM orders
                       WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00') AS s,
                      (SELECT count(*) FROM stage_dup) AS t)
       SELECT s AS source_incremental_count, t AS target_count,
              greatest(0, s - t) AS missing_count, greatest(0, t - s) AS extra_count,
              s = t AS is_valid FROM c""",
    uses=("stage_dup",),
)
def reconcile_incremental(t: Tables) -> DataFrame:
    recent = "o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'"
    return R.reconcile_incremental(t.orders, t.stage_dup, recent)


def rows_sql(columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS compared,
                   count(*) FILTER (o.{c} IS DISTINCT FROM t.{c}) AS mismatches
            FROM orders o JOIN orders_tgt t ON o.o_orderkey = t.o_orderkey"""
        for c in columns
    )


VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("reconcile_rows", rows_sql(VALUES), uses=("orders_tgt",))
def reconcile_rows(t: Tables) -> DataFrame:
    return R.reconcile_rows(t.orders, t.orders_tgt, "o_orderkey")


@query("reconcile_rows_digest", rows_sql(VALUES), uses=("orders_tgt",))
def reconcile_rows_digest(t: Tables) -> DataFrame:
    """Differences everywhere: no range can be left out."""
    return G.reconcile_rows_digest(t.orders, t.orders_tgt, "o_orderkey")


@query(
    "reconcile_rows_drift", rows_sql(VALUES).replace("orders_tgt", "orders_drift"), uses=("orders_drift",)
)
def reconcile_rows_drift(t: Tables) -> DataFrame:
    """Differences in few ranges, found in several rounds."""
    return G.reconcile_rows_digest(t.orders, t.orders_drift, "o_orderkey", fan_out=64, enough=200)


@query("reconcile_keys_digest", keys_sql("orders", "orders_drift"), uses=("orders_drift",))
def reconcile_keys_digest(t: Tables) -> DataFrame:
    return G.reconcile_keys_digest(t.orders, t.orders_drift, "o_orderkey")


@query(
    "reconcile_multi",
    """, c AS (SELECT 'copy' AS target, count(*) AS target_count FROM orders_ymd
               UNION ALL SELECT 'stale', count(*) FROM orders_tgt
               UNION ALL SELECT 'partial', count(*) FROM orders_hwm_tgt),
         v AS (SELECT *, (SELECT count(*) FROM orders) AS source_count,
                      target_count = (SELECT count(*) FROM orders) AS is_valid FROM c)
       SELECT *, (SELECT bool_and(is_valid) FROM v) AS all_valid FROM v""",
    uses=("orders_ymd", "orders_tgt", "orders_hwm_tgt"),
)
def reconcile_multi(t: Tables) -> DataFrame:
    targets = {"copy": t.orders_ymd, "stale": t.orders_tgt, "partial": t.orders_hwm_tgt}
    return R.reconcile_multi(t.orders, targets)


@query(
    "version_distribution",
    """SELECT count(*) AS total_records, min(version) AS min_version,
              max(version) AS max_version, CAST(round(avg(version)) AS BIGINT) AS avg_version,
              CAST(round(stddev_samp(version)) AS BIGINT) AS stddev_version,
              max(version) - min(version) AS version_range
       FROM orders_ymd""",
    uses=("orders_ymd",),
)
def version_distribution(t: Tables) -> DataFrame:
    return R.version_distribution(t.orders_ymd, "version")


STATUS_SQL = """, s AS (SELECT max(version) AS hi, count(*) AS n FROM orders_ymd),
    d AS (SELECT max(o_orderkey * 2) AS last, count(*) AS n FROM orders_hwm_tgt),
    status AS (
      SELECT s.hi AS source_max_version, d.last AS target_last_version,
             s.hi <= 0 OR d.last >= s.hi AS is_synchronized,
             CASE WHEN s.hi > 0 THEN greatest(0, s.hi - d.last) ELSE 0 END AS sync_gap,
             s.n AS source_count, d.n AS target_count
      FROM s, d)"""


def sync_status(t: Tables) -> DataFrame:
    target = t.orders_hwm_tgt.withColumn("source_version", F.col("o_orderkey") * 2)
    return R.version_sync_status(t.orders_ymd, target, "version")


@query(
    "version_sync_status",
    f"{STATUS_SQL} SELECT * FROM status",
    uses=("orders_ymd", "orders_hwm_tgt"),
)
def version_sync_status(t: Tables) -> DataFrame:
    return sync_status(t)


@query(
    "integrity_score",
    f"""{STATUS_SQL}
        SELECT source_max_version, sync_gap, round(greatest(0.0::DOUBLE, 1.0::DOUBLE
               - CASE WHEN is_synchronized THEN 0.0 ELSE 0.3 END
               - CASE WHEN sync_gap > 1000000 THEN 0.2 WHEN sync_gap > 100000 THEN 0.1
                      ELSE 0.0 END
               - CASE WHEN source_count > 0 AND target_count > 0 THEN
                   (1.0 - least(source_count, target_count)::DOUBLE
                          / greatest(source_count, target_count)) * 0.2 ELSE 0.0 END), 9)
               AS integrity_score
        FROM status""",
    uses=("orders_ymd", "orders_hwm_tgt"),
)
def integrity_score(t: Tables) -> DataFrame:
    scored = R.integrity_score(sync_status(t))
    return scored.select(
        "source_max_version", "sync_gap", F.round("integrity_score", 9).alias("integrity_score")
    )


@query("search_ilike", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%License%'")
def search_ilike(t: Tables) -> DataFrame:
    return P.search(t.documents, "text", "License").select("doc_id", "lang")


@query(
    "sort_page",
    "SELECT ticker, country_code, close_price FROM stock_master ORDER BY country_code DESC, ticker",
    uses=("stock_master",),
)
def sort_page(t: Tables) -> DataFrame:
    rows = t.stock_master.select("ticker", "country_code", "close_price")
    return P.sort_page(rows, "country_code", "DESC", "ticker")


@query(
    "query_page",
    """SELECT ticker, country_code, close_price FROM stock_master
       WHERE ticker ILIKE '%1%'
       ORDER BY country_code DESC NULLS FIRST, ticker LIMIT 50 OFFSET 50""",
    uses=("stock_master",),
)
def query_page(t: Tables) -> DataFrame:
    rows = P.search(t.stock_master.select("ticker", "country_code", "close_price"), "ticker", "1")
    return P.page(rows, 2, 50, "country_code", "DESC", "ticker")


@query(
    "query_page_deep",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
       ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
       LIMIT 100 OFFSET 3900""",
)
def query_page_deep(t: Tables) -> DataFrame:
    """A page far back, in the same total order as the first one."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = t.lineitem.select(*key, "l_shipdate")
    return P.page(rows, 40, 100, "l_shipdate", "ASC", key)


@query(
    "page_meta",
    """SELECT count(*) AS total_count, (count(*) + 99) // 100 AS total_pages FROM documents
       WHERE text ILIKE '%License%'""",
)
def page_meta(t: Tables) -> DataFrame:
    return P.page_meta(P.search(t.documents, "text", "License"), 100)


@query(
    "query_keyset_page",
    "SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100",
)
def query_keyset_page(t: Tables) -> DataFrame:
    return P.keyset_page(t.orders, "o_orderkey", 1000, 100)


@query(
    "run_log",
    """SELECT CAST(run_id AS VARCHAR) AS run_id, pipeline, CAST(NULL AS VARCHAR) AS step,
              status, started_at, CAST(NULL AS TIMESTAMP) AS ended_at, duration_s, rows_copied,
              CAST(NULL AS BIGINT) AS checkpoint_count, error_count,
              CAST(NULL AS BIGINT) AS warning_count, memory_mb, CAST(NULL AS VARCHAR) AS message
       FROM run_log""",
    uses=("run_log",),
)
def run_log(t: Tables) -> DataFrame:
    return A.run_log(t.run_log).drop("metrics")


@query(
    "run_progress",
    """SELECT pipeline, count(*) AS total_steps,
              count(*) FILTER (status = 'completed') AS completed_steps,
              count(*) FILTER (status = 'failed') AS failed_steps,
              count(*) FILTER (status = 'running') AS running_steps,
              round(count(*) FILTER (status = 'completed') * 100.0::DOUBLE / count(*), 6)
                AS progress_percentage
       FROM run_log GROUP BY pipeline""",
    uses=("run_log",),
)
def run_progress(t: Tables) -> DataFrame:
    rounded = F.round("progress_percentage", 6)
    return A.progress(t.run_log, "pipeline").withColumn("progress_percentage", rounded)


@query(
    "run_health",
    """, f AS (
         SELECT pipeline, max(duration_s) / 60 AS longest_minutes,
                count(*) FILTER (status = 'completed') * 100.0::DOUBLE
                  / count(*) FILTER (status <> 'running') AS success_rate_percent,
                max(error_count) AS most_errors, max(memory_mb) AS peak_memory_mb
         FROM run_log GROUP BY pipeline),
       g AS (SELECT *, longest_minutes > 60 AS is_slow, success_rate_percent < 90 AS is_failing,
                    most_errors >= 3 AS has_many_errors, peak_memory_mb > 2048 AS is_memory_high
             FROM f)
       SELECT * REPLACE (round(longest_minutes, 6) AS longest_minutes,
                         round(success_rate_percent, 6) AS success_rate_percent),
              NOT (is_slow OR is_failing OR has_many_errors OR is_memory_high) AS is_healthy
       FROM g""",
    uses=("run_log",),
)
def run_health(t: Tables) -> DataFrame:
    return A.health(t.run_log).withColumns(
        {
            "longest_minutes": F.round("longest_minutes", 6),
            "success_rate_percent": F.round("success_rate_percent", 6),
        }
    )


@query(
    "run_throughput",
    """SELECT run_id,
              CASE WHEN duration_s > 0 THEN rows_copied / duration_s ELSE 0 END
                AS rows_per_second,
              CASE WHEN memory_mb > 0 THEN rows_copied / memory_mb ELSE 0 END AS rows_per_mb
       FROM run_log""",
    uses=("run_log",),
)
def run_throughput(t: Tables) -> DataFrame:
    return A.throughput(t.run_log).select("run_id", "rows_per_second", "rows_per_mb")


@query(
    "chunk_timings",
    """, ranked AS (
         SELECT *, row_number() OVER (PARTITION BY pipeline
                                      ORDER BY started_at DESC, run_id DESC) AS r
         FROM run_log)
       SELECT pipeline, count(*) AS chunks, round(avg(duration_s), 6) AS avg_s,
              min(duration_s) AS min_s, max(duration_s) AS max_s,
              round(avg(memory_mb), 6) AS avg_memory_mb, max(memory_mb) AS max_memory_mb,
              round(avg(duration_s) FILTER (r <= 100), 6) AS recent_avg_s
       FROM ranked GROUP BY pipeline""",
    uses=("run_log",),
)
def chunk_timings(t: Tables) -> DataFrame:
    return A.chunk_timings(t.run_log, "pipeline", ["started_at", "run_id"]).withColumns(
        {c: F.round(c, 6) for c in ("avg_s", "avg_memory_mb", "recent_avg_s")}
    )


@query(
    "run_summary",
    """SELECT CASE WHEN grouping(pipeline) = 1 THEN 'ALL' ELSE pipeline END AS pipeline,
              count(*) AS runs, count(*) FILTER (status = 'completed') AS completed_runs,
              count(*) FILTER (status = 'failed') AS failed_runs,
              count(*) FILTER (status = 'running') AS running_runs,
              max(started_at) FILTER (status = 'completed') AS last_successful_run,
              round(avg(duration_s / 60), 6) AS avg_execution_time_minutes,
              round(count(*) FILTER (status = 'completed') * 100.0::DOUBLE
                    / count(*) FILTER (status <> 'running'), 6) AS success_rate_percent
       FROM run_log GROUP BY ROLLUP (pipeline)""",
    uses=("run_log",),
)
def run_summary(t: Tables) -> DataFrame:
    return A.summary(t.run_log).withColumns(
        {
            c: F.round(c, 6)
            for c in ("avg_execution_time_minutes", "success_rate_percent")
        }
    )
