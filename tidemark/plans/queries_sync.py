"""Registered queries: merges, change logs, streams, history, models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import cols
from tidemark.operators import change_log as log
from tidemark.operators import history as H
from tidemark.operators.asof import as_of_join
from tidemark.operators.keys import dedupe, key_violations
from tidemark.operators.lookup import rows_of_keys, write_clustered
from tidemark.operators.merge import merge, merge_stats
from tidemark.operators.stage import staged
from tidemark.plans import models
from tidemark.plans.registry import Tables, query
from tidemark.plans.snapshots import SnapshotTable
from tidemark.plans.sync import merge_into, sync_all, sync_by_mode, sync_table, table_at
from tidemark.session import work_dir
from tidemark.sources.versions import BucketedTable, VersionedTable
from tidemark.spec import SyncSpec
from tidemark.streaming import streams
from tidemark.streaming.polling import PolledTable

RUN_TS = "2025-08-13 01:00:00"
FIRST_TS = "2025-08-12 01:00:00"
MIDDLE_TS = "2025-08-12 13:00:00"
ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# Orders that changed since the target was loaded: the staged delta of most merges.
STAGE_SQL = """, stage AS (
  SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00')"""

LATEST_SQL = """, latest AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS r
    FROM stage_dup) WHERE r = 1)"""


def delta(t: Tables) -> DataFrame:
    return t.orders.where("o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'")


@query(
    "merge_delete_insert",
    f"""{STAGE_SQL}
        SELECT {ORDERS} FROM orders_tgt
        WHERE NOT EXISTS (SELECT 1 FROM stage_dup s WHERE s.o_orderkey = orders_tgt.o_orderkey)
        UNION ALL SELECT {ORDERS} FROM stage_dup""",
    uses=("orders_tgt", "stage_dup"),
)
def merge_delete_insert(t: Tables) -> DataFrame:
    return merge(t.orders_tgt, t.stage_dup, "o_orderkey", "delete_insert", on_duplicate="keep")


@query(
    "merge_insert_ignore",
    f"""{STAGE_SQL}
        SELECT {ORDERS} FROM orders_tgt
        UNION ALL SELECT {ORDERS} FROM stage
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_tgt)""",
    uses=("orders_tgt",),
)
def merge_insert_ignore(t: Tables) -> DataFrame:
    return merge(t.orders_tgt, delta(t), "o_orderkey", "insert_ignore")


UPSERT_SQL = f"""{LATEST_SQL}
    SELECT {ORDERS} FROM orders_tgt
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
    UNION ALL SELECT {ORDERS} FROM latest"""


@query("merge_upsert", UPSERT_SQL, uses=("orders_tgt", "stage_dup"))
def merge_upsert(t: Tables) -> DataFrame:
    return merge(
        t.orders_tgt,
        t.stage_dup,
        "o_orderkey",
        "upsert",
        on_duplicate="latest",
        order_by="o_orderdate",
    )


@query("merge_upsert_bucketed", UPSERT_SQL, uses=("orders_tgt", "stage_dup"))
def merge_upsert_bucketed(t: Tables) -> DataFrame:
    """The same merge into a table split by key, where untouched buckets are not rewritten."""
    table = BucketedTable(t.spark, work_dir(t.spark, "orders"), ("o_orderkey",), 16)
    table.write(t.orders_tgt)
    with staged(t.spark, t.stage_dup) as stage:
        merge_into(
            table,
            stage.rows,
            ["o_orderkey"],
            "incremental_sync",
            on_duplicate="latest",
            order_by=["o_orderdate"],
        )
    return table.read()


@query("merge_upsert_mixed_key_types", UPSERT_SQL, uses=("orders_tgt", "stage_dup"))
def merge_upsert_mixed_key_types(t: Tables) -> DataFrame:
    """A stage with narrow keys into a bucketed table with wide ones, split anew halfway."""
    base = work_dir(t.spark, "orders")
    BucketedTable(t.spark, base, ("o_orderkey",), 8).write(t.orders_tgt)
    narrow = t.stage_dup.withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    options = {"on_duplicate": "latest", "order_by": ["o_orderdate"]}
    with staged(t.spark, narrow) as stage:
        for n in (8, 4):
            table = BucketedTable(t.spark, base, ("o_orderkey",), n)
            merge_into(table, stage.rows, ["o_orderkey"], "incremental_sync", **options)
    return table.read()


@query(
    "incremental_version_wide",
    """SELECT o_orderkey, CAST(o_orderkey AS BIGINT) * 1000000000000 AS source_version
       FROM orders""",
)
def incremental_version_wide(t: Tables) -> DataFrame:
    """Two syncs by a 64-bit version, the second over a part of the source: no row is lost."""
    source = t.orders.select("o_orderkey", (F.col("o_orderkey") * F.lit(10**12)).alias("xv"))
    base = work_dir(t.spark, "wide")
    spec = SyncSpec("orders", source, "o_orderkey", "version_sync", "xv")
    sync_table(t.spark, spec, base, RUN_TS)
    limited = replace(spec, where="o_orderkey % 2 = 0", version_range_limit=2_000_000_000)
    sync_table(t.spark, limited, base, RUN_TS)
    return table_at(t.spark, base, "orders").read().select("o_orderkey", "source_version")


@query(
    "merge_full_sync",
    """SELECT o.*, CASE WHEN t.o_orderkey IS NOT NULL THEN 'kept' END AS note
       FROM orders o LEFT JOIN orders_tgt t ON o.o_orderkey = t.o_orderkey""",
    uses=("orders_tgt",),
)
def merge_full_sync(t: Tables) -> DataFrame:
    """The target has a column of its own, which matched rows keep."""
    target = t.orders_tgt.withColumn("note", F.lit("kept"))
    return merge(target, t.orders, "o_orderkey", "full_sync")


@query(
    "merge_incremental",
    f"""{STAGE_SQL}
        SELECT {ORDERS}, CAST(NULL AS TIMESTAMP) AS updated_at FROM orders_tgt
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stage)
        UNION ALL
        SELECT {ORDERS}, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders_tgt)
                              THEN TIMESTAMP '{RUN_TS}' END
        FROM stage""",
    uses=("orders_tgt",),
)
def merge_incremental(t: Tables) -> DataFrame:
    return merge(t.orders_tgt, delta(t), "o_orderkey", "incremental", run_ts=RUN_TS)


@query(
    "merge_keys_only",
    """SELECT o_orderkey, o_custkey FROM orders_tgt
       UNION SELECT o_orderkey, o_custkey FROM orders""",
    uses=("orders_tgt",),
)
def merge_keys_only(t: Tables) -> DataFrame:
    """A table without value columns."""
    keys = ["o_orderkey", "o_custkey"]
    return merge(t.orders_tgt.select(*keys), t.orders.select(*keys), keys, "upsert")


VERSIONED_TARGET = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderkey * 2 AS source_version,
           TIMESTAMP '2020-01-01 00:00:00' AS created_at
    FROM orders_tgt"""
VERSIONED_STAGE = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, version AS source_version,
           TIMESTAMP '2024-01-01 00:00:00' AS created_at
    FROM orders_ymd WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'"""


@query(
    "merge_versioned",
    f""", tgt AS ({VERSIONED_TARGET}), stg AS ({VERSIONED_STAGE})
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
               coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
               coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
               coalesce(s.source_version, t.source_version) AS source_version,
               coalesce(t.created_at, s.created_at) AS created_at,
               CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL
                    THEN TIMESTAMP '{RUN_TS}' END AS updated_at
        FROM tgt t FULL JOIN stg s ON s.o_orderkey = t.o_orderkey""",
    uses=("orders_tgt", "orders_ymd"),
)
def merge_versioned(t: Tables) -> DataFrame:
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]

    def created(ts: str):
        return F.lit(ts).cast("timestamp_ntz").alias("created_at")

    target = t.orders_tgt.select(
        *columns,
        (F.col("o_orderkey") * 2).alias("source_version"),
        created("2020-01-01 00:00:00"),
    )
    newer = t.orders_ymd.where("o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    stage = newer.select(
        *columns, F.col("version").alias("source_version"), created("2024-01-01 00:00:00")
    )
    return merge(target, stage, "o_orderkey", "versioned", run_ts=RUN_TS)


@query(
    "merge_stats",
    """, pairs AS (
         SELECT t.o_orderkey AS tk, o.o_orderkey AS sk,
                (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority)
                IS DISTINCT FROM
                (o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority)
                AS changed
         FROM orders_tgt t FULL JOIN orders o ON t.o_orderkey = o.o_orderkey)
       SELECT count(sk) AS staged, count(tk) AS "before",
              count(*) FILTER (tk IS NULL) AS inserted,
              count(*) FILTER (tk IS NOT NULL AND sk IS NOT NULL AND changed) AS updated,
              count(*) FILTER (tk IS NOT NULL AND sk IS NOT NULL AND NOT changed) AS unchanged,
              count(*) FILTER (sk IS NULL) AS not_staged,
              count(*) AS "after", count(*) FILTER (tk IS NULL) AS merged
       FROM pairs""",
    uses=("orders_tgt",),
)
def stats(t: Tables) -> DataFrame:
    return merge_stats(t.orders_tgt, t.orders, "o_orderkey")


@query(
    "sync_by_mode",
    f"""{STAGE_SQL}
        SELECT 'full_copy' AS mode, count(*) AS n, sum(o_orderkey) AS key_sum FROM orders
        UNION ALL SELECT 'full_sync', count(*), sum(o_orderkey) FROM orders
        UNION ALL
        SELECT 'incremental_sync', count(*), sum(o_orderkey) FROM (
          SELECT o_orderkey FROM orders_tgt UNION SELECT o_orderkey FROM stage)
        UNION ALL
        SELECT 'cdc', count(*), sum(o_orderkey) FROM (
          SELECT o_orderkey FROM orders_tgt UNION SELECT o_orderkey FROM stage)""",
    uses=("orders_tgt",),
)
def by_mode(t: Tables) -> DataFrame:
    results = None
    for mode in ("full_copy", "full_sync", "incremental_sync", "cdc"):
        source = t.orders if mode.startswith("full") else delta(t)
        merged = sync_by_mode(t.orders_tgt, source, ["o_orderkey"], mode)
        row = merged.agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
        ).withColumn("mode", F.lit(mode))
        results = row if results is None else results.unionByName(row)
    return results


@query(
    "key_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS n, 'duplicate' AS reason FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def violations(t: Tables) -> DataFrame:
    return key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "cdc_append_log",
    """SELECT 'orders' AS table_name, 'INSERT' AS operation,
              CAST(o_orderkey AS VARCHAR) AS record_id, CAST(NULL AS VARCHAR) AS old_data,
              TIMESTAMP '2025-08-13 01:00:00' AS changed_at, o_custkey, o_totalprice,
              o_orderpriority
       FROM orders""",
)
def cdc_append_log(t: Tables) -> DataFrame:
    entries = log.append_log(t.orders, "orders", "o_orderkey", RUN_TS)
    row = F.from_json("new_data", t.orders.schema)
    return entries.withColumn("row", row).select(
        "table_name",
        "operation",
        "record_id",
        "old_data",
        "changed_at",
        "row.o_custkey",
        "row.o_totalprice",
        "row.o_orderpriority",
    )


@query(
    "cdc_diff",
    """SELECT coalesce(o.o_orderkey, t.o_orderkey) AS o_orderkey,
              CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' WHEN o.o_orderkey IS NULL
                   THEN 'DELETE' ELSE 'UPDATE' END AS operation,
              t.o_totalprice AS old_price, o.o_totalprice AS new_price
       FROM orders_tgt t FULL JOIN orders o ON o.o_orderkey = t.o_orderkey
       WHERE t.o_orderkey IS NULL OR o.o_orderkey IS NULL
          OR (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority)
             IS DISTINCT FROM
             (o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority)""",
    uses=("orders_tgt",),
)
def cdc_diff(t: Tables) -> DataFrame:
    return log.diff(t.orders_tgt, t.orders, "o_orderkey").select(
        F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey"),
        "operation",
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
    )


@query("cdc_apply", "SELECT * FROM orders")
def cdc_apply(t: Tables) -> DataFrame:
    """Replaying the stored difference on the old state gives the new one."""
    changes = log.diff(t.orders_tgt, t.orders, "o_orderkey")
    stored = log.to_log(changes, "orders", "o_orderkey", RUN_TS)
    replay = log.from_log(stored, t.orders.schema)
    return log.apply_log(t.orders_tgt, replay, "o_orderkey")


def arriving(t: Tables, df: DataFrame) -> DataFrame:
    """``df`` as a stream of files, half as many in a batch as there are shuffle partitions."""
    path = work_dir(t.spark, "files")
    partitions = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(partitions).write.parquet(path)
    return streams.file_stream(t.spark, path, df.schema, max(1, partitions // 2))


@query(
    "stream_incremental_merge",
    f"""{LATEST_SQL}
        SELECT {ORDERS} FROM orders_hwm_tgt
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
        UNION ALL SELECT {ORDERS} FROM latest""",
    uses=("orders_hwm_tgt", "stage_dup"),
)
def stream_incremental_merge(t: Tables) -> DataFrame:
    table = VersionedTable(t.spark, work_dir(t.spark, "orders"))
    table.write(t.orders_hwm_tgt)
    checkpoint = work_dir(t.spark, "checkpoint")
    streams.stream_merge(
        arriving(t, t.stage_dup), table, "o_orderkey", checkpoint, "o_orderdate"
    ).awaitTermination()
    return table.read()


@query(
    "stream_merge_after_load",
    f"""{LATEST_SQL}
        SELECT {ORDERS} FROM orders_hwm_tgt
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
        UNION ALL SELECT {ORDERS} FROM latest""",
    uses=("orders_hwm_tgt", "stage_dup"),
)
def stream_merge_after_load(t: Tables) -> DataFrame:
    """A stream run, a full load that takes the next versions, and a stream run with the rest."""
    table = VersionedTable(t.spark, work_dir(t.spark, "orders"))
    inbox, checkpoint = work_dir(t.spark, "inbox"), work_dir(t.spark, "checkpoint")
    source = t.stage_dup
    late = F.col("o_orderkey") % 2 == 0
    for part, load in ((~late, True), (late, False)):
        source.where(part).write.mode("append").parquet(inbox)
        stream = streams.file_stream(t.spark, inbox, source.schema)
        streams.stream_merge(stream, table, "o_orderkey", checkpoint, "o_orderdate").awaitTermination()
        if load:
            streamed = table.read()
            for _ in range(2):
                table.write(merge(t.orders_hwm_tgt, streamed, "o_orderkey", "upsert"))
    return table.read()


@query(
    "sync_cdc_two_runs",
    """SELECT CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS operation,
              CAST(o.o_orderkey AS VARCHAR) AS record_id,
              t.o_totalprice AS old_price, o.o_totalprice AS new_price
       FROM orders o LEFT JOIN orders_tgt t ON o.o_orderkey = t.o_orderkey
       WHERE t.o_orderkey IS NULL OR
             (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority)
             IS DISTINCT FROM
             (o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority)""",
    uses=("orders_tgt",),
)
def sync_cdc_two_runs(t: Tables) -> DataFrame:
    """A change-capturing sync over a loaded target, run twice: the second run logs nothing."""
    base = work_dir(t.spark, "synced")
    table_at(t.spark, base, "orders").write(t.orders_tgt)
    spec = SyncSpec("orders", t.orders, "o_orderkey", "cdc")
    for _ in range(2):
        sync_table(t.spark, spec, base, RUN_TS)

    def price(side: str) -> Column:
        return F.get_json_object(side, "$.o_totalprice").cast("double")

    return t.spark.read.parquet(f"{base}/orders_cdc").select(
        "operation",
        "record_id",
        price("old_data").alias("old_price"),
        price("new_data").alias("new_price"),
    )


@query(
    "stream_cdc_log",
    """SELECT 'orders' AS table_name, 'INSERT' AS operation,
              CAST(o_orderkey AS VARCHAR) AS record_id, o_orderdate AS changed_at, o_custkey
       FROM orders""",
)
def stream_cdc_log(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "log")
    checkpoint = work_dir(t.spark, "checkpoint")
    streams.stream_change_log(
        arriving(t, t.orders), path, "orders", "o_orderkey", "o_orderdate", checkpoint
    ).awaitTermination()
    customer = F.get_json_object("new_data", "$.o_custkey").cast("long").alias("o_custkey")
    return t.spark.read.parquet(path).select(
        "table_name", "operation", "record_id", "changed_at", customer
    )


@query("stream_dedupe", "SELECT * FROM orders")
def stream_dedupe(t: Tables) -> DataFrame:
    """Two polls of which the second re-reads the last day of the first."""
    first = t.orders_hwm_tgt
    mark = first.agg(F.date_trunc("day", F.max("o_orderdate")).cast("string")).first()[0]
    inbox, out = work_dir(t.spark, "inbox"), work_dir(t.spark, "unique")
    checkpoint = work_dir(t.spark, "checkpoint")
    for poll in (first, t.orders.where(F.col("o_orderdate") >= F.lit(mark).cast("timestamp_ntz"))):
        poll.write.mode("append").parquet(inbox)
        polled = streams.file_stream(t.spark, inbox, first.schema)
        unique = streams.stream_dedupe(polled, "o_orderkey", "o_orderdate", "2 days")
        streams.write_stream(unique, out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out)


@query("stream_dedupe_late", "SELECT * FROM events")
def stream_dedupe_late(t: Tables) -> DataFrame:
    """Polls in order of time, then repeats of old rows, and rows of unseen keys that come weeks late."""
    events = t.events
    inbox, out = work_dir(t.spark, "inbox"), work_dir(t.spark, "unique")
    checkpoint = work_dir(t.spark, "checkpoint")
    missed = F.col("event_id") % 10 == 0
    polls = (
        events.where(~missed),
        events.where(F.col("event_id") % 3 == 1).unionByName(events.where(missed)),
        events.where(F.col("event_id") % 4 == 0),
    )
    for poll in polls:
        poll.write.mode("append").parquet(inbox)
        stream = streams.file_stream(t.spark, inbox, events.schema)
        streams.stream_dedupe_into(stream, out, "event_id", "ts", checkpoint, "2 days").awaitTermination()
    return streams.UniqueRows(t.spark, out).rows(events.schema)


FEW_SQL = """SELECT {columns} FROM lineitem WHERE l_orderkey IN (
    SELECT o_orderkey FROM orders WHERE o_orderkey % {step} = 3)"""
LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_quantity"


def lookup_rows(t: Tables, step: int) -> DataFrame:
    """Rows of a clustered table with Bloom filters, for every ``step``-th order."""
    path = work_dir(t.spark, "clustered")
    source = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    write_clustered(source, path, ("l_orderkey", "l_linenumber"), 8, 1 << 20)
    target = t.spark.read.schema(source.schema).parquet(path)
    keys = t.orders.where(F.col("o_orderkey") % step == 3).select(F.col("o_orderkey").alias("l_orderkey"))
    return rows_of_keys(target, keys, "l_orderkey")


@query("lookup_few_keys", FEW_SQL.format(columns=LINE_COLUMNS, step=150))
def lookup_few_keys(t: Tables) -> DataFrame:
    """As lists of keys."""
    return lookup_rows(t, 150)


@query("lookup_many_keys", FEW_SQL.format(columns=LINE_COLUMNS, step=7))
def lookup_many_keys(t: Tables) -> DataFrame:
    """As ranges around them."""
    return lookup_rows(t, 7)


@query("stream_polled_table", "SELECT * FROM orders")
def stream_polled_table(t: Tables) -> DataFrame:
    """A growing table polled four times, the third time in vain, and streamed under one checkpoint."""
    orders, path = t.orders, work_dir(t.spark, "polled")
    out, checkpoint = work_dir(t.spark, "streamed"), work_dir(t.spark, "checkpoint")
    polled = PolledTable(t.spark, path, "o_orderdate")
    for before in ("1997-01-01", "1999-06-15", "1999-06-15", "2100-01-01"):
        polled.poll(orders.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz")))
        streams.write_stream(polled.stream(orders.schema), out, checkpoint).awaitTermination()
    return t.spark.read.schema(orders.schema).parquet(out)


@query(
    "sync_cdc_repeated_keys",
    f"""{LATEST_SQL}
        SELECT CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS operation,
               CAST(l.o_orderkey AS VARCHAR) AS record_id
        FROM latest l LEFT JOIN orders_hwm_tgt t USING (o_orderkey)""",
    uses=("orders_hwm_tgt", "stage_dup"),
)
def sync_cdc_repeated_keys(t: Tables) -> DataFrame:
    """Keys that are staged twice are logged as they are merged, once; a second run logs nothing."""
    base = work_dir(t.spark, "synced")
    table_at(t.spark, base, "orders").write(t.orders_hwm_tgt)
    spec = SyncSpec(
        "orders", t.stage_dup, "o_orderkey", "cdc", on_duplicate="latest", order_by=("o_orderdate",)
    )
    for _ in range(2):
        sync_table(t.spark, spec, base, RUN_TS)
    return t.spark.read.parquet(f"{base}/orders_cdc").select("operation", "record_id")


SYNC_SQL = """
    SELECT 'orders' AS target, 'full_sync' AS mode, 'completed' AS status,
           count(*) AS staged_rows, count(*) AS target_rows FROM orders
    UNION ALL SELECT 'events', 'incremental_sync', 'completed', count(*), count(*) FROM events
    UNION ALL SELECT 'customer', 'full_copy', 'completed', count(*), count(*) FROM customer
    UNION ALL SELECT 'lineitem', 'incremental_sync', 'failed', NULL, NULL"""


@query("sync_all_tables", SYNC_SQL)
def sync_all_tables(t: Tables) -> DataFrame:
    """Four tables; the one with repeated keys fails and the others still complete."""
    specs = [
        SyncSpec("orders", t.orders, ("o_orderkey",), "full_sync"),
        SyncSpec("events", t.events, ("event_id",), "incremental_sync", "ts", "timestamp"),
        SyncSpec("customer", t.customer, (), "full_copy"),
        SyncSpec(
            "lineitem",
            t.lineitem,
            ("l_orderkey", "l_linenumber"),
            "incremental_sync",
            "l_shipdate",
            "date",
        ),
    ]
    results = sync_all(t.spark, specs, work_dir(t.spark, "synced"), RUN_TS)
    return results.select("target", "mode", "status", "staged_rows", "target_rows")


PK = ["code", "exchange", "gts_exnm", "ticker"]
PK_SQL = "code || '|' || exchange || '|' || gts_exnm || '|' || ticker"
CHECKED = ["country_code", "isin", "name_local", "name_en", "close_price", "curr"]


@query(
    "composite_key",
    f"SELECT ticker, {PK_SQL} AS pk FROM stock_master",
    uses=("stock_master",),
)
def composite_key(t: Tables) -> DataFrame:
    return t.stock_master.select("ticker", H.composite_key(PK).alias("pk"))


def with_pk(df: DataFrame) -> DataFrame:
    return df.withColumn("pk", H.composite_key(PK))


def snapshot_sql(hard_deletes: bool) -> str:
    """History after the second load: versions kept, closed, and opened."""
    gone = "WHEN n.pk IS NULL THEN TIMESTAMP '2025-08-13 01:00:00'" if hard_deletes else ""
    a = ", ".join(f"o.{c}" for c in CHECKED)
    b = ", ".join(f"n.{c}" for c in CHECKED)
    shown = ["ticker", "country_code", "as_of", "close_price"]
    return f""", o AS (SELECT *, {PK_SQL} AS pk FROM stock_master),
        n AS (SELECT *, {PK_SQL} AS pk FROM stock_master_v2)
        SELECT o.pk, {", ".join("o." + c for c in shown)},
               TIMESTAMP '{FIRST_TS}' AS scd_valid_from,
               CASE {gone} WHEN n.pk IS NOT NULL AND ({a}) IS DISTINCT FROM ({b})
                    THEN TIMESTAMP '{RUN_TS}' END AS scd_valid_to
        FROM o LEFT JOIN n ON o.pk = n.pk
        UNION ALL
        SELECT n.pk, {", ".join("n." + c for c in shown)}, TIMESTAMP '{RUN_TS}', NULL
        FROM n LEFT JOIN o ON o.pk = n.pk
        WHERE o.pk IS NULL OR ({a}) IS DISTINCT FROM ({b})"""


SNAPSHOT_COLUMNS = [
    "pk",
    "ticker",
    "country_code",
    "as_of",
    "close_price",
    "scd_valid_from",
    "scd_valid_to",
]


def two_loads(t: Tables, hard_deletes: bool) -> DataFrame:
    first = H.snapshot(None, with_pk(t.stock_master), "pk", "check", FIRST_TS)
    return H.snapshot(
        first,
        with_pk(t.stock_master_v2),
        "pk",
        "check",
        RUN_TS,
        check_cols=CHECKED,
        hard_deletes=hard_deletes,
    )


STOCK = ("stock_master", "stock_master_v2")


@query("snapshot_check", snapshot_sql(False), uses=STOCK)
def snapshot_check(t: Tables) -> DataFrame:
    return two_loads(t, False).select(*SNAPSHOT_COLUMNS)


@query("snapshot_hard_delete", snapshot_sql(True), uses=STOCK)
def snapshot_hard_delete(t: Tables) -> DataFrame:
    return two_loads(t, True).select(*SNAPSHOT_COLUMNS)


@query("snapshot_three_runs", snapshot_sql(True), uses=STOCK)
def snapshot_three_runs(t: Tables) -> DataFrame:
    """A stored history after two loads and a repetition of the second, which changes nothing."""
    table = SnapshotTable(
        t.spark, work_dir(t.spark, "history"), "pk", check_cols=tuple(CHECKED), hard_deletes=True
    )
    table.run(with_pk(t.stock_master), FIRST_TS)
    for _ in range(2):
        table.run(with_pk(t.stock_master_v2), RUN_TS)
    return table.read().select(*SNAPSHOT_COLUMNS)


# The same history under a name, for SQL that goes on from it.
HISTORY_SQL = snapshot_sql(True).replace("SELECT o.pk,", ", h AS (SELECT o.pk,", 1) + ")"


MIDDLE_SQL = """, middle AS (
    SELECT code, exchange, gts_exnm, ticker, country_code, isin, name_local, name_en, as_of,
           CASE WHEN ticker LIKE '%5' THEN close_price + 7e0 ELSE close_price END AS close_price, curr
    FROM stock_master WHERE ticker NOT LIKE '%2')"""


def three_loads_sql() -> str:
    """Versions of three whole loads in order of time: every run of equal rows of a key is one."""
    every = ", ".join(["pk", "ticker", *CHECKED])
    return f"""{MIDDLE_SQL}, loads AS (
      SELECT 1 AS n, {every} FROM (SELECT *, {PK_SQL} AS pk FROM stock_master)
      UNION ALL SELECT 2, {every} FROM (SELECT *, {PK_SQL} AS pk FROM middle)
      UNION ALL SELECT 3, {every} FROM (SELECT *, {PK_SQL} AS pk FROM stock_master_v2)),
    marked AS (SELECT *, lag(n) OVER w AS before_n,
        lag(struct_pack({", ".join(f"{c} := {c}" for c in CHECKED)})) OVER w AS before_row
      FROM loads WHERE pk IS NOT NULL WINDOW w AS (PARTITION BY pk ORDER BY n)),
    starts AS (SELECT *, before_n IS NULL OR before_n <> n - 1 OR before_row IS DISTINCT FROM
        struct_pack({", ".join(f"{c} := {c}" for c in CHECKED)}) AS begins FROM marked),
    numbered AS (SELECT *, sum(begins::INT) OVER (PARTITION BY pk ORDER BY n) AS v FROM starts),
    stops AS (SELECT * FROM (VALUES (1, TIMESTAMP '{FIRST_TS}'), (2, TIMESTAMP '{MIDDLE_TS}'),
      (3, TIMESTAMP '{RUN_TS}'), (4, NULL)) AS x(n, ts))
    SELECT pk, close_price, a.ts AS scd_valid_from, b.ts AS scd_valid_to
    FROM (SELECT pk, v, min(n) AS low, max(n) AS high, any_value(close_price) AS close_price
          FROM numbered GROUP BY pk, v) JOIN stops a ON a.n = low JOIN stops b ON b.n = high + 1"""


@query("snapshot_out_of_order", three_loads_sql(), uses=STOCK)
def snapshot_out_of_order(t: Tables) -> DataFrame:
    """The second of three loads comes last, the first one second."""
    first = t.stock_master
    late = F.col("ticker").like("%5")
    middle = first.where("ticker NOT LIKE '%2'").withColumn(
        "close_price", F.when(late, F.col("close_price") + 7).otherwise(F.col("close_price"))
    )
    loads = {FIRST_TS: first, MIDDLE_TS: middle, RUN_TS: t.stock_master_v2}
    history, seen = None, []
    for ts in (RUN_TS, FIRST_TS, MIDDLE_TS):
        rows = with_pk(loads[ts]).select("pk", "ticker", *CHECKED).where("pk IS NOT NULL")
        history = H.splice_load(history, rows, "pk", ts, H.next_load(seen, ts), check_cols=CHECKED)
        seen.append(ts)
    return history.select("pk", "close_price", "scd_valid_from", "scd_valid_to")


LATE_DAYS = (10, 30, 20)
LATE_SQL = " ".join(
    f"""UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice - {d}, o_orderdate - INTERVAL {d} DAY,
        o_orderpriority FROM orders WHERE o_orderkey % {d} < 5"""
    for d in LATE_DAYS
)


@query(
    "snapshot_late_rows",
    f"""SELECT {ORDERS}, o_orderdate AS scd_valid_from, lead(o_orderdate) OVER (
          PARTITION BY o_orderkey ORDER BY o_orderdate) AS scd_valid_to
        FROM (SELECT {ORDERS} FROM orders {LATE_SQL})""",
)
def snapshot_late_rows(t: Tables) -> DataFrame:
    """A history by row time that gets older rows, before all it holds and in between."""
    history = H.splice_rows(None, t.orders, "o_orderkey", "o_orderdate")
    for d in LATE_DAYS:
        old = t.orders.where(F.col("o_orderkey") % d < 5).withColumns(
            {"o_totalprice": F.col("o_totalprice") - d,
             "o_orderdate": F.col("o_orderdate") - F.expr(f"INTERVAL '{d}' DAY")}
        )
        history = H.splice_rows(history, old, "o_orderkey", "o_orderdate")
    return history.select(*cols(t.orders.columns), "scd_valid_from", "scd_valid_to")


LAST_ORDER = """SELECT o.o_orderkey, p.o_orderkey AS last_orderkey, p.o_totalprice AS last_totalprice
    FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 1) o ASOF LEFT JOIN (
      SELECT * FROM orders WHERE o_orderkey % 2 = 0
      QUALIFY row_number() OVER (PARTITION BY {key}, o_orderdate ORDER BY o_orderkey DESC) = 1) p
    ON o.{key} = p.{key} AND o.o_orderdate >= p.o_orderdate"""


def last_order(t: Tables, key: str) -> DataFrame:
    """For every second order the last of the others with the same key."""
    orders = t.orders
    facts = orders.where("o_orderkey % 2 = 1").select("o_orderkey", key, F.col("o_orderdate").alias("at"))
    others = orders.where("o_orderkey % 2 = 0").select(
        key, F.col("o_orderdate").alias("since"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("totalprice"),
    )
    found = as_of_join(facts, others, key, "at", "since", prefix="last_")
    return found.select("o_orderkey", "last_orderkey", "last_totalprice")


@query("asof_join", LAST_ORDER.format(key="o_custkey"))
def asof_join(t: Tables) -> DataFrame:
    return last_order(t, "o_custkey")


@query("asof_join_hot_key", LAST_ORDER.format(key="o_orderstatus"))
def asof_join_hot_key(t: Tables) -> DataFrame:
    """A third of all rows have one key."""
    return last_order(t, "o_orderstatus")


@query(
    "asof_join_history",
    f"""{HISTORY_SQL}, facts AS (
          SELECT pk, ts FROM (SELECT {PK_SQL} AS pk FROM stock_master), (VALUES
            (TIMESTAMP '2025-08-01 00:00:00'), (TIMESTAMP '{FIRST_TS}'), (TIMESTAMP '2025-08-30 00:00:00')) AS x(ts))
        SELECT f.pk, ts, h.close_price AS was_close_price FROM facts f LEFT JOIN h ON h.pk = f.pk
          AND h.scd_valid_from <= ts AND (h.scd_valid_to IS NULL OR h.scd_valid_to > ts)""",
    uses=STOCK,
)
def asof_join_history(t: Tables) -> DataFrame:
    """Rows of several times against a history with ends: a deleted key holds nothing afterwards."""
    times = F.array(*[F.lit(x).cast("timestamp_ntz") for x in ("2025-08-01 00:00:00", FIRST_TS, "2025-08-30 00:00:00")])
    facts = with_pk(t.stock_master).select("pk", F.explode(times).alias("ts"))
    history = two_loads(t, True).select("pk", "close_price", "scd_valid_from", "scd_valid_to")
    found = as_of_join(facts, history, "pk", "ts", "scd_valid_from", "scd_valid_to", prefix="was_")
    return found.select("pk", "ts", "was_close_price")


@query(
    "snapshot_timestamp",
    f"""{LATEST_SQL}
        SELECT {ORDERS}, o_orderdate AS scd_valid_from,
               (SELECT l.o_orderdate FROM latest l WHERE l.o_orderkey = o.o_orderkey
                AND l.o_orderdate > o.o_orderdate) AS scd_valid_to,
               o_orderdate AS scd_updated_at
        FROM orders o
        UNION ALL
        SELECT l.*, l.o_orderdate, NULL, l.o_orderdate
        FROM latest l JOIN orders o USING (o_orderkey) WHERE l.o_orderdate > o.o_orderdate""",
    uses=("stage_dup",),
)
def snapshot_timestamp(t: Tables) -> DataFrame:
    first = H.snapshot(None, t.orders, "o_orderkey", "timestamp", updated_at="o_orderdate")
    newer = dedupe(t.stage_dup, "o_orderkey", "o_orderdate")
    return H.snapshot(first, newer, "o_orderkey", "timestamp", updated_at="o_orderdate")


@query(
    "snapshot_as_of",
    f"""SELECT code, exchange, gts_exnm, ticker, country_code, isin, close_price, curr,
               {PK_SQL} AS pk
        FROM stock_master_v2""",
    uses=STOCK,
)
def snapshot_as_of(t: Tables) -> DataFrame:
    """With deletions followed, the history at the latest time is the latest load."""
    state = H.as_of(two_loads(t, True), "2025-08-14 00:00:00")
    return state.select(*PK, "country_code", "isin", "close_price", "curr", "pk")


@query(
    "snapshot_history",
    f"{HISTORY_SQL} SELECT * FROM h WHERE country_code = 'KR'",
    uses=STOCK,
)
def snapshot_history(t: Tables) -> DataFrame:
    rows = two_loads(t, True).select(*SNAPSHOT_COLUMNS)
    return H.history_of(rows, "pk", only="country_code = 'KR'")


@query(
    "snapshot_gaps",
    f"""{HISTORY_SQL} SELECT * FROM h WHERE scd_valid_to IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM h x WHERE x.pk = h.pk AND x.scd_valid_from = h.scd_valid_to)""",
    uses=STOCK,
)
def snapshot_gaps(t: Tables) -> DataFrame:
    return H.history_gaps(two_loads(t, True).select(*SNAPSHOT_COLUMNS), "pk")


DIM_SQL = """, dim AS (
    SELECT *, code IS NOT NULL AND length(code) > 0 AS is_valid_code,
           exchange IS NOT NULL AND length(exchange) > 0 AS is_valid_exchange,
           close_price IS NOT NULL AND close_price > 0 AS is_valid_price,
           CASE country_code WHEN 'US' THEN '미국' WHEN 'KR' THEN '한국' WHEN 'JP' THEN '일본'
                WHEN 'CN' THEN '중국' ELSE '기타' END AS "국가명",
           CASE WHEN close_price >= 100 THEN '고가주' WHEN close_price >= 50 THEN '중가주'
                ELSE '저가주' END AS "가격대분류"
    FROM stock_master)"""


@query("dim_stock_master", f"{DIM_SQL} SELECT * FROM dim", uses=("stock_master",))
def dim_stock_master(t: Tables) -> DataFrame:
    return models.dim_stock_master(t.stock_master)


@query(
    "model_chain",
    f"""{DIM_SQL}, first AS (
          SELECT ticker, "국가명" FROM dim WHERE is_valid_code
          UNION ALL SELECT NULL, "국가명" FROM dim WHERE NOT is_valid_code)
        SELECT * FROM first WHERE ticker IS NOT NULL""",
    uses=("stock_master",),
)
def model_chain(t: Tables) -> DataFrame:
    dimension = models.dim_stock_master(t.stock_master)
    first = models.first_model(dimension, "ticker", F.col("is_valid_code"))
    return models.second_model(first, "ticker").select(
        *cols(["ticker", models.COUNTRY_NAME_COLUMN])
    )
