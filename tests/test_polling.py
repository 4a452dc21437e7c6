"""Polls of a table as a stream: each row once, restarts, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import streams
from tidemark.streaming.polling import PolledTable

SCHEMA = "k int, at timestamp_ntz"


def hour(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def frame(spark, ks):
    return spark.createDataFrame([(k, hour(k)) for k in ks], SCHEMA)


def keys(df):
    return sorted(r["k"] for r in df.collect())


def test_three_polls_one_checkpoint_exactly_once(spark, tmp_path):
    polled = PolledTable(spark, str(tmp_path / "p"), "at")
    schema = frame(spark, [1]).schema
    for upto, number in ((3, 0), (3, None), (7, 1), (9, 2)):
        assert polled.poll(frame(spark, range(upto))) == number
        query = streams.write_stream(polled.stream(schema), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
    assert keys(spark.read.parquet(str(tmp_path / "out"))) == list(range(9))
    assert [r["poll"] for r in polled.read(schema).orderBy("k").collect()] == [0] * 3 + [1] * 4 + [2] * 2


def test_a_failed_poll_is_done_again_for_the_same_range(spark, tmp_path):
    polled = PolledTable(spark, str(tmp_path / "p"), "at")
    polled.poll(frame(spark, range(3)))
    bad = frame(spark, range(6)).withColumn("k", F.when(F.col("k") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="lost"):
        polled.poll(bad)
    # By now the source has grown: the second poll keeps its range, the third takes the rest.
    assert polled.poll(frame(spark, range(9))) == 1
    assert polled.poll(frame(spark, range(9))) == 2
    got = {r["k"]: r["poll"] for r in polled.read(frame(spark, [1]).schema).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2, 8: 2}


def test_late_rows_with_a_lag_and_de_duplication(spark, tmp_path):
    polled = PolledTable(spark, str(tmp_path / "p"), "at", lag="5 hours")
    schema = frame(spark, [1]).schema
    for ks in ([1, 2, 8], [1, 2, 6, 8, 10], [1, 2, 6, 8, 10]):
        polled.poll(frame(spark, ks))
        streams.stream_dedupe_into(
            polled.stream(schema), str(tmp_path / "out"), "k", "at", str(tmp_path / "cp"), "1 day"
        ).awaitTermination()
    assert keys(streams.UniqueRows(spark, str(tmp_path / "out")).rows(schema)) == [1, 2, 6, 8, 10]


def test_null_times_and_an_empty_table(spark, tmp_path):
    polled = PolledTable(spark, str(tmp_path / "p"), "at")
    assert polled.poll(frame(spark, [])) is None
    rows = spark.createDataFrame([(1, None), (2, hour(2))], SCHEMA)
    assert polled.poll(rows) == 0 and polled.poll(rows) is None
    assert keys(polled.read(rows.schema)) == [1, 2]
