"""Sources, sinks, versioned tables, staging, syncs and streams."""

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import ColumnSpec
from tidemark.operators import audit
from tidemark.operators.change_log import record_id
from tidemark.operators.merge import merge
from tidemark.operators.stage import stage, staged
from tidemark.plans import models
from tidemark.plans.sync import (
    check_keys,
    fan_out,
    fan_out_counts,
    merge_into,
    sync_all,
    sync_table,
    table_at,
)
from tidemark.session import CHECKPOINT_DIR, shared_dir
from tidemark.sources.jdbc import JdbcTable
from tidemark.sources.scan import (
    balanced_chunks,
    chunk_by_key,
    chunk_stats,
    scan,
    scan_count,
    scan_sql,
)
from tidemark.sources.text import read_csv_text, to_ndjson, write_csv, write_ndjson
from tidemark.sources.versions import BucketedTable, VersionedTable, path_exists
from tidemark.spec import SyncSpec, TargetSpec
from tidemark.streaming import streams

SCHEMA = "k int, v string, at timestamp_ntz"


def day(n):
    return dt.datetime(2025, 1, n)


def table(spark, rows):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in rows], SCHEMA)


def content(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


def test_scan_columns_filter_and_errors(spark, sf_dir):
    df = scan(spark, f"{sf_dir}/nation.parquet")
    some = scan(spark, df, [df.columns[1]], f"{df.columns[0]} < 3")
    assert some.columns == [df.columns[1]] and some.count() == 3
    assert scan_count(spark, df).first()[0] == df.count()
    with pytest.raises(ValueError):
        scan(spark, df, ["nope"])
    with pytest.raises(ValueError):
        scan(spark, "drop table; x")


def test_custom_sql_binds_values(spark):
    df = spark.createDataFrame([("a' OR '1'='1", 1), ("b", 2)], "s string, n int")
    got = scan_sql(spark, "SELECT n FROM {t} WHERE s = :s", {"t": df}, {"s": "a' OR '1'='1"})
    assert [r[0] for r in got.collect()] == [1]


def test_chunks_cover_all_keys_once(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    stats = chunk_stats(chunk_by_key(df, "k", 7), "k").collect()
    assert sum(r["n"] for r in stats) == 1000 and len(stats) == 7
    assert max(r["n"] for r in stats) - min(r["n"] for r in stats) <= 1


def test_chunks_of_huge_negative_and_null_keys(spark):
    df = spark.createDataFrame([(-(2**63),), (0,), (2**63 - 1,), (None,)], "k long")
    got = {r["k"]: r["chunk"] for r in chunk_by_key(df, "k", 4).collect()}
    assert got == {-(2**63): 0, 0: 2, 2**63 - 1: 3, None: None}
    assert chunk_by_key(df.where("false"), "k", 4).count() == 0


def test_balanced_chunks_of_skewed_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id")).otherwise(10**12).alias("k"))
    parts = balanced_chunks(df, "k", 4).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 500


AWKWARD = ["plain", "NA", 'say "hi"', "a,b", "two\nlines", " spaced ", "한글", "tab\t", "back\\slash"]


def test_csv_keeps_awkward_text(spark, tmp_path):
    rows = [(i, v) for i, v in enumerate([*AWKWARD, "", None])]
    path = str(tmp_path / "csv")
    write_csv(spark.createDataFrame(rows, "i int, v string").repartition(3), path)
    back = read_csv_text(spark, path, ["v", "i"], file_columns=["i", "v"], multi_line=True)
    got = {int(r["i"]): r["v"] for r in back.collect()}
    assert got == {i: (v or None) for i, v in rows}


def test_ndjson(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "한글")], "i int, v string")
    assert [r[0] for r in to_ndjson(df, 10, "i").collect()] == [
        '{"i":1,"v":"한글"}',
        '{"i":2,"v":null}',
    ]
    assert to_ndjson(df, 1, "i").count() == 1
    for bad in (0, 10_001):
        with pytest.raises(ValueError):
            to_ndjson(df, bad)
    path = str(tmp_path / "nd")
    write_ndjson(df, path)
    lines = [
        json.loads(line)
        for f in os.listdir(path) if f.endswith(".json")
        for line in open(os.path.join(path, f), encoding="utf-8")
    ]
    assert sorted(lines, key=lambda r: r["i"]) == [{"i": 1, "v": "한글"}, {"i": 2, "v": None}]


def test_jdbc_options():
    t = JdbcTable("jdbc:postgresql://db/x", "public.t", "me", "secret", partition_column="id",
                  lower_bound=0, upper_bound=100, num_partitions=4)
    options = t.read_options()
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    assert "partitionColumn" not in t.write_options() and t.write_options()["batchsize"] == "10000"
    assert "secret" not in repr(t)
    assert "user" not in JdbcTable("jdbc:postgresql://db/x", "t").read_options()
    bounds = t.bounds_query("id").table
    assert bounds == "(SELECT min(id) AS lo, max(id) AS hi FROM public.t t) bounds"
    with pytest.raises(ValueError):
        JdbcTable("u", "t", partition_column="id")


class FakeSession:
    """Only what shared_dir looks at."""

    def __init__(self, app="app-1", **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}
        self.sparkContext = type("Context", (), {"applicationId": app})


def test_shared_dir():
    set_up = FakeSession(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")
    assert shared_dir(set_up) == "hdfs://x/y"
    local = FakeSession(spark_master="local[2]")
    assert shared_dir(local) == shared_dir(local) and os.path.isdir(shared_dir(local))
    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        shared_dir(FakeSession(spark_master="yarn"))


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert not t.exists() and t.row_count() == 0
    with pytest.raises(FileNotFoundError):
        t.read()
    t.write(table(spark, [(1, "a", 1), (2, "b", 1)]))
    # A new version may be computed from the current one.
    t.write(t.read().where("k = 1"))
    assert content(t.read()) == [(1, "a")]
    assert content(t.read(1)) == [(1, "a"), (2, "b")]
    assert (t.version(), t.version(below=2), t.row_count()) == (2, 1, 1)
    t.write(t.read().where("false"))
    assert t.read().count() == 0 and t.read().columns == ["k", "v", "at"]


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.write(table(spark, [(1, "a", 1)]))
    broken = spark.range(100).select(
        F.when(F.col("id") == 99, F.raise_error("boom").cast("int")).otherwise(F.col("id")).alias("k")
    )
    with pytest.raises(Exception, match="boom"):
        t.write(broken)
    assert t.version() == 1 and content(t.read()) == [(1, "a")]
    assert t.write(table(spark, [(5, "e", 1)])) == 2
    assert content(t.read()) == [(5, "e")]


def test_replayed_version_is_ignored(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.write(table(spark, [(1, "a", 1)]), version=1)
    t.write(table(spark, [(9, "z", 1)]), version=1)
    assert content(t.read()) == [(1, "a")]


def test_bucketed_merge_touches_few_buckets(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "b"), ("k",), 8)
    t.write(table(spark, [(i, "old", 1) for i in range(100)]))
    before = {e["bucket"]: e["path"] for e in t._entries(1)}
    merge_into(t, table(spark, [(3, "new", 2), (200, "add", 2)]), ["k"], "incremental_sync")
    after = {e["bucket"]: e["path"] for e in t._entries(2)}
    changed = [b for b in before if before[b] != after[b]]
    assert 1 <= len(changed) <= 2
    rows = dict(content(t.read()))
    assert len(rows) == 101 and rows[3] == "new" and rows[200] == "add" and rows[4] == "old"
    assert t.row_count() == 101 and t.read(1).count() == 100
    merge_into(t, table(spark, []), ["k"], "incremental_sync")
    assert t.read().count() == 101
    merge_into(t, table(spark, [(7, "only", 3)]), ["k"], "full_sync")
    assert content(t.read()) == [(7, "only")]


def test_stage_counts_and_cleans_up(spark):
    df = table(spark, [(1, "a", 1), (2, "b", 1)])
    with staged(spark, df) as s:
        assert s.row_count == 2 and s.rows.count() == 2
    assert not path_exists(spark, s.path)
    with pytest.raises(RuntimeError), staged(spark, df) as s:
        raise RuntimeError
    assert not path_exists(spark, s.path)
    assert stage(spark, df.where("false")).row_count == 0


def spec(source, **kw):
    kw = {"target": "t", "keys": ("k",), "mode": "incremental_sync", "incremental_field": "at",
          "incremental_type": "timestamp"} | kw
    return SyncSpec(source=source, **kw)


@pytest.mark.parametrize("buckets", [None, 4])
def test_incremental_sync_over_three_runs(spark, tmp_path, buckets):
    base, ts = str(tmp_path), day(9)
    kw = {"buckets": buckets}
    first = sync_table(spark, spec(table(spark, [(1, "a", 1), (2, "b", 2)]), **kw), base, ts)
    assert (first["staged_rows"], first["target_rows"], first["version"]) == (2, 2, 1)
    source = table(spark, [(1, "a", 1), (2, "B", 3), (3, "c", 3)])
    second = sync_table(spark, spec(source, **kw), base, ts)
    assert (second["staged_rows"], second["target_rows"]) == (2, 3)
    third = sync_table(spark, spec(source, **kw), base, ts)
    assert (third["staged_rows"], third["target_rows"]) == (0, 3)
    assert content(VersionedTable(spark, f"{base}/t").read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_custom_filter_replaces_or_joins_the_incremental_one(spark, tmp_path):
    source = table(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    base = str(tmp_path)
    sync_table(spark, spec(source, where="k = 2"), base, day(9))
    again = sync_table(spark, spec(source, where="k <= 2"), base, day(9))
    assert again["staged_rows"] == 2
    both = sync_table(spark, spec(source, where="k <> 1", combine="and"), base, day(9))
    assert both["staged_rows"] == 1


def test_lag_picks_up_late_rows(spark, tmp_path):
    base = str(tmp_path)
    sync_table(spark, spec(table(spark, [(1, "a", 5)])), base, day(9))
    late = table(spark, [(1, "a", 5), (2, "late", 4), (3, "too late", 1)])
    without = sync_table(spark, spec(late), base, day(9))
    assert without["staged_rows"] == 0
    sync_table(spark, spec(late, lag="2 days"), base, day(9))
    assert content(VersionedTable(spark, f"{base}/t").read()) == [(1, "a"), (2, "late")]


def test_version_sync(spark, tmp_path):
    base = str(tmp_path)
    schema = "k int, v string, xv long"

    def run(rows, **kw):
        source = spark.createDataFrame(rows, schema)
        s = SyncSpec("t", source, "k", "version_sync", "xv", **kw)
        return sync_table(spark, s, base, day(9))

    def now():
        rows = VersionedTable(spark, f"{base}/t").read().collect()
        return sorted((r["k"], r["v"], r["source_version"], r["updated_at"]) for r in rows)

    assert run([(1, "a", 5), (2, "b", 6)])["staged_rows"] == 2
    second = run([(1, "a", 5), (2, "B", 8), (3, "c", 9)])
    assert (second["staged_rows"], second["target_rows"]) == (2, 3)
    assert now() == [(1, "a", 5, None), (2, "B", 8, day(9)), (3, "c", 9, None)]
    assert run([(3, "C", 10), (4, "d", 11)], where="k > 3")["staged_rows"] == 1
    # Wide versions are versions like others; with a limit every row is looked at. Neither deletes.
    before = now()
    run([(9, "z", 3_000_000_000)])
    run([(1, "a", 5), (9, "z", 3_000_000_000)], where="k > 1", version_range_limit=2_000_000_000)
    assert now() == [*before, (9, "z", 3_000_000_000, day(9))]
    with pytest.raises(ValueError, match="no row has a version"):
        run([(1, "a", None)])


def test_full_sync_and_cdc(spark, tmp_path):
    base = str(tmp_path)
    full = {"mode": "full_sync", "incremental_field": None}
    sync_table(spark, spec(table(spark, [(1, "a", 1), (2, "b", 1)]), **full), base, day(9))
    sync_table(spark, spec(table(spark, [(2, "B", 1)]), **full), base, day(9))
    assert content(VersionedTable(spark, f"{base}/t").read()) == [(2, "B")]
    cdc = {"mode": "cdc", "incremental_field": None}
    sync_table(spark, spec(table(spark, [(3, "c", 1)]), **cdc), base, day(9))
    assert content(VersionedTable(spark, f"{base}/t").read()) == [(2, "B"), (3, "c")]
    log = spark.read.parquet(f"{base}/t_cdc").collect()
    assert [(r["record_id"], r["operation"]) for r in log] == [("3", "INSERT")]


def test_sync_cleans_shapes_and_checks(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1.0", "null", "2025-01-01"), (" 2 ", "x", "nan")], "k string, v string, at string"
    )
    shape = [
        ColumnSpec("k", "integer", nullable=False),
        ColumnSpec("v", "text"),
        ColumnSpec("at", "timestamp"),
        ColumnSpec("loaded_at", "timestamp", default="now()"),
    ]
    s = SyncSpec("t", raw, "k", "full_sync", shape=shape, check_keys=True)
    row = sync_table(spark, s, str(tmp_path), day(9))
    assert (row["missing_in_target"], row["extra_in_target"]) == (0, 0)
    got = VersionedTable(spark, f"{tmp_path}/t").read().orderBy("k")
    assert [tuple(r) for r in got.collect()] == [(1, None, day(1), day(9)), (2, "x", None, day(9))]


def test_check_keys_finds_what_is_missing(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.write(table(spark, [(1, "a", 1), (3, "c", 1)]))
    rows = table(spark, [(1, "a", 1), (2, "b", 1)])
    with pytest.raises(RuntimeError, match="1 keys missing, 1 keys extra"):
        check_keys(spec(rows), rows, t)
    known = table(spark, [(1, "a", 1)])
    assert check_keys(spec(known), known, t) == {"missing_in_target": 0, "extra_in_target": 1}


def test_sync_all_keeps_going(spark, tmp_path):
    good = table(spark, [(1, "a", 1)])
    specs = [
        spec(good, target="good", mode="full_copy", incremental_field=None),
        spec("/no/such/path.parquet", target="bad"),
        spec(good, target="off", enabled=False),
    ]
    log = str(tmp_path / "runs")
    results = sync_all(spark, specs, str(tmp_path), day(9), log_path=log, run_id="r1")
    rows = {r["target"]: r for r in results.collect()}
    assert set(rows) == {"good", "bad"}
    assert rows["good"]["status"] == "completed" and rows["bad"]["status"] == "failed"
    assert "PATH_NOT_FOUND" in rows["bad"]["message"]
    (progress,) = audit.progress(audit.read_runs(spark, log)).collect()
    assert tuple(progress) == ("r1", 2, 1, 1, 0, 50.0)


def test_fan_out(spark, tmp_path):
    source = table(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1)])
    targets = [TargetSpec("every"), TargetSpec("some", "incremental_sync", "k > 1")]
    for _ in range(2):
        got = fan_out(spark, source, targets, str(tmp_path), ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [("every", 3), ("some", 2)]
    assert sorted(tuple(r) for r in fan_out_counts(source, targets).collect()) == [
        ("every", 3), ("some", 2),
    ]
    with pytest.raises(RuntimeError, match="bad"):
        fan_out(spark, source, [TargetSpec("bad", where="nope = 1")], str(tmp_path))


@pytest.mark.parametrize(
    "kw",
    [
        {"target": "bad name"},
        {"keys": ("1k",)},
        {"mode": "sideways"},
        {"keys": ()},
        {"incremental_field": None},
        {"incremental_type": "weekly"},
        {"combine": "or"},
        {"on_duplicate": "shrug"},
        {"on_duplicate": "latest"},
        {"buckets": 0},
    ],
)
def test_bad_specs(kw):
    with pytest.raises(ValueError):
        spec("s", **kw)


def test_hangul_names_are_valid():
    assert spec("s", target="종목마스터", keys=("티커",)).keys == ("티커",)


def arrive(spark, path, rows):
    table(spark, rows).write.mode("append").parquet(path)


def run_merge(spark, inbox, t, checkpoint):
    stream = streams.file_stream(spark, inbox, t.read().schema, files_per_batch=1)
    streams.stream_merge(stream, t, "k", checkpoint, "at").awaitTermination()


@pytest.mark.parametrize("buckets", [None, 4])
def test_stream_merge_equals_batch_merge(spark, tmp_path, buckets):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    t = table_at(spark, str(tmp_path), "t", ["k"], buckets)
    start = table(spark, [(1, "a", 1), (2, "b", 1)])
    t.write(start)
    arrive(spark, inbox, [(2, "B", 2), (3, "c", 1), (3, "C", 2)])
    run_merge(spark, inbox, t, checkpoint)
    arrive(spark, inbox, [(1, "A", 3)])
    run_merge(spark, inbox, t, checkpoint)
    delta = table(spark, [(2, "B", 2), (3, "c", 1), (3, "C", 2), (1, "A", 3)])
    assert content(t.read()) == content(merge(start, delta, "k", "upsert", "latest", "at"))
    # Without new files nothing is written.
    version = t.version()
    run_merge(spark, inbox, t, checkpoint)
    assert t.version() == version


def log_stream(spark, inbox, log, schema, checkpoint):
    stream = streams.file_stream(spark, inbox, schema)
    streams.stream_change_log(stream, log, "t", "k", "at", checkpoint).awaitTermination()


def test_stream_replays_do_not_repeat(spark, tmp_path):
    """A batch that is run again, and a lost checkpoint of a merge; the table stays as it was."""
    inbox, log, cp = (str(tmp_path / n) for n in ("in", "log", "cp1"))
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.write(table(spark, [(1, "a", 1)]))
    arrive(spark, inbox, [(2, "b", 2)])
    run_merge(spark, inbox, t, str(tmp_path / "cp"))
    before = content(t.read())
    for _ in range(2):
        log_stream(spark, inbox, log, t.read().schema, cp)
        # The batch's end is forgotten: it runs again.
        for f in (tmp_path / "cp1" / "commits").glob("*0*"):
            f.unlink()
    assert spark.read.parquet(log).count() == 1
    run_merge(spark, inbox, t, str(tmp_path / "cp9"))
    assert content(t.read()) == before


def test_two_checkpoints_add_to_one_change_log(spark, tmp_path):
    """Both number their batches from 0."""
    log = str(tmp_path / "log")
    for k, rows in enumerate(([(i, "a", 1) for i in range(5)], [(i, "b", 1) for i in range(10, 15)])):
        inbox = str(tmp_path / f"in{k}")
        arrive(spark, inbox, rows)
        log_stream(spark, inbox, log, table(spark, []).schema, str(tmp_path / f"cp{k}"))
    assert spark.read.parquet(log).count() == 10


def test_a_checkpoint_made_anew_at_the_same_place_is_another_stream(spark, tmp_path):
    """Its first batch isn't the one the old checkpoint committed."""
    t, cp = VersionedTable(spark, str(tmp_path / "t")), tmp_path / "cp"
    t.write(table(spark, [(1, "a", 1)]))
    arrive(spark, str(tmp_path / "in1"), [(2, "b", 2)])
    run_merge(spark, str(tmp_path / "in1"), t, str(cp))
    shutil.rmtree(cp)
    arrive(spark, str(tmp_path / "in2"), [(3, "c", 3)])
    run_merge(spark, str(tmp_path / "in2"), t, str(cp))
    assert content(t.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_cdc_logs_what_the_policy_for_repeated_keys_keeps(spark, tmp_path):
    rows = table(spark, [(1, "a", 1), (1, "b", 2), (2, "x", 1)])
    spec = SyncSpec("t", rows, "k", "cdc", on_duplicate="latest", order_by=("at",))
    for _ in range(2):
        sync_table(spark, spec, str(tmp_path), dt.datetime(2024, 1, 1))
    log = spark.read.parquet(f"{tmp_path}/t_cdc").select("operation", "record_id").collect()
    assert sorted(map(tuple, log)) == [("INSERT", "1"), ("INSERT", "2")]
    fan_out(spark, rows, [TargetSpec("f", "cdc", keys=("k",), on_duplicate="latest", order_by=("at",))], str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/f_cdc").count() == 2


def test_record_ids_of_different_keys_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "b"), ("a", "\\|b"), ("a\\|", "b"), ("plain", "x")]
    df = spark.createDataFrame(rows, "p string, q string")
    ids = [r[0] for r in df.select(record_id(["p", "q"])).collect()]
    assert len(set(ids)) == len(rows) and ids[-1] == "plain|x"


def test_late_rows_are_routed(spark, tmp_path):
    """On time, late and unseen, late repeats, NULL keys, no time; then a replay and a new checkpoint."""
    inbox, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "k int, v string, at timestamp_ntz"

    def day(d, h=0):
        return dt.datetime(2024, 1, d, h)

    def run(checkpoint):
        stream = streams.file_stream(spark, inbox, spark.createDataFrame([], schema).schema)
        streams.stream_dedupe_into(stream, out, "k", "at", checkpoint, "1 day").awaitTermination()

    polls = [
        [(1, "a", day(1)), (2, "b", day(10)), (2, "later", day(10, 1)), (None, "n", day(10))],
        # 1 again but late, 3 late and unseen, twice; 2 again in time; 4 in time; without a key; without a time
        [(1, "again", day(2)), (3, "c", day(3)), (3, "cc", day(4)), (2, "again", day(10, 5)), (4, "d", day(11)),
         (None, "n", day(10)), (5, "e", None), (1, "no time", None)],
        # Late repeats of rows that came late.
        [(3, "again", day(3)), (5, "again", day(5)), (6, "f", day(20))],
    ]
    for rows in polls:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        run(cp)
    unique = streams.UniqueRows(spark, out)
    want = [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f"), (None, "n"), (None, "n")]

    def found():
        rows = unique.rows(spark.createDataFrame([], schema).schema).select("k", "v").collect()
        return sorted(map(tuple, rows), key=repr)

    assert found() == sorted(want, key=repr)
    marks = [tuple(r) for r in unique.marks().orderBy("batch_id").select("on_time", "late", "repeated").collect()]
    assert marks == [(3, 0, 1), (2, 2, 4), (1, 0, 2)]
    # The last batch runs again.
    for f in (tmp_path / "cp" / "commits").glob("*2*"):
        f.unlink()
    run(cp)
    assert found() == sorted(want, key=repr)
    # Everything comes again under a new checkpoint: only rows without a key equal nothing.
    run(str(tmp_path / "cp2"))
    assert found() == sorted([*want, (None, "n"), (None, "n")], key=repr)


def test_stream_dedupe_across_polls(spark, tmp_path):
    inbox, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows in ([(1, "a", 1), (2, "b", 2)], [(2, "b", 2), (3, "c", 2)]):
        arrive(spark, inbox, rows)
        stream = streams.file_stream(spark, inbox, table(spark, []).schema)
        unique = streams.stream_dedupe(stream, "k", "at")
        streams.write_stream(unique, out, cp).awaitTermination()
    assert content(spark.read.parquet(out)) == [(1, "a"), (2, "b"), (3, "c")]


def test_models(spark, tmp_path):
    source = spark.createDataFrame(
        [("A", "X", "US", 100.0), (None, "", "VN", None), ("", "Y", None, 50.0), ("B", "Z", "KR", -1.0)],
        "code string, exchange string, country_code string, close_price double",
    )
    rows = [tuple(r)[4:] for r in models.dim_stock_master(source).collect()]
    assert rows == [
        (True, True, True, "미국", "고가주"),
        (False, False, False, "기타", "저가주"),
        (False, True, True, "기타", "중가주"),
        (True, True, False, "한국", "저가주"),
    ]
    first = models.first_model(models.dim_stock_master(source), "code", F.col("is_valid_code"))
    assert first.count() == 4 and first.where("code IS NULL").count() == 2
    assert models.second_model(first, "code").count() == 2
    assert models.second_model(first, "code", F.col("code") == "B").count() == 1
    assert models.model_schema("main") == "main" and models.model_schema("main", " x ") == "main_x"
    for _ in range(2):
        name = models.materialize(spark, source, "m", "t", "models", str(tmp_path / "s"))
    assert spark.table(name).count() == 4


@pytest.mark.parametrize("first, then", [(None, 8), (8, 4), (4, 8), (8, None)])
def test_bucketed_table_opened_with_another_layout(spark, tmp_path, first, then):
    base = str(tmp_path / "t")

    def opened(n):
        return BucketedTable(spark, base, ("k",), n) if n else VersionedTable(spark, base)

    opened(first).write(spark.createDataFrame([(i, "old") for i in range(100)], "k long, v string"))
    for rows in ([(3, "new"), (200, "new")], [(4, "new")]):
        merge_into(opened(then), spark.createDataFrame(rows, "k int, v string"), ["k"], "incremental_sync")
    got = content(opened(then).read())
    assert got == sorted((i, "new" if i in (3, 4, 200) else "old") for i in [*range(100), 200])
    with pytest.raises(ValueError, match="another way|not split"):
        BucketedTable(spark, base, ("k",), 5).touched(spark.createDataFrame([(1,)], "k long"))


def test_stream_goes_on_after_another_writer(spark, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    t = VersionedTable(spark, str(tmp_path / "t"))

    def arrive(*rows):
        df = spark.createDataFrame(rows, "k int, v string, at int")
        df.write.mode("append").parquet(inbox)
        stream = streams.file_stream(spark, inbox, df.schema)
        streams.stream_merge(stream, t, "k", checkpoint, "at").awaitTermination()

    arrive((1, "a", 1))
    for _ in range(3):
        t.write(spark.createDataFrame([(1, "a", 1), (2, "loaded", 1)], "k int, v string, at int"))
    arrive((3, "late batch", 2))
    assert [r[0] for r in content(t.read())] == [1, 2, 3]


def test_cdc_logs_changes_only(spark, tmp_path):
    base, cdc = str(tmp_path), {"mode": "cdc", "incremental_field": None}
    for rows in ([(1, "a", 1), (2, "b", 1)], [(1, "a", 1), (2, "b", 1)], [(1, "A", 1), (3, "c", 1)]):
        sync_table(spark, spec(table(spark, rows), **cdc), base, day(9))
    log = spark.read.parquet(f"{base}/t_cdc").collect()
    ops = sorted((r["operation"], r["record_id"], r["old_data"] is None) for r in log)
    assert ops == [("INSERT", "1", True), ("INSERT", "2", True), ("INSERT", "3", True), ("UPDATE", "1", False)]


def test_fan_out_checks_the_first_load(spark, tmp_path):
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, at int")
    with pytest.raises(RuntimeError, match="strict"):
        fan_out(spark, source, [TargetSpec("strict", "incremental_sync", keys=("k",))], str(tmp_path))
    latest = TargetSpec("latest", "incremental_sync", None, ("k",), "latest", ("at",))
    for _ in range(2):
        counts = fan_out(spark, source, [latest, TargetSpec("copy")], str(tmp_path))
        assert sorted(map(tuple, counts.collect())) == [("copy", 3), ("latest", 2)]


def test_values_that_do_not_fit_fail_or_are_counted(spark, tmp_path):
    source = spark.createDataFrame([("1", "abcdef", "x9"), ("2", "ok", "7")], "k string, t string, n string")
    shape = (ColumnSpec("k", "integer"), ColumnSpec("t", "varchar", max_length=3), ColumnSpec("n", "integer"))
    for mode in ("full_sync", "full_copy"):
        s = SyncSpec(f"t_{mode}", source, "k", mode, shape=shape)
        with pytest.raises(ValueError, match="'t': 1, 'n': 1"):
            sync_table(spark, s, str(tmp_path), day(9))
        assert not VersionedTable(spark, f"{tmp_path}/t_{mode}").exists()
        counted = SyncSpec(f"t_{mode}", source, "k", mode, shape=shape, on_bad_value="null")
        row = sync_table(spark, counted, str(tmp_path), day(9))
        assert row["staged_rows"] == 2 and "'n': 1" in row["message"]
