"""Types and formats found in text columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import infer as I


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def found(spark, values, **kw):
    return I.infer(I.format_counts(frame(spark, values)), **kw)["v"]


@pytest.mark.parametrize(
    "values,kind",
    [
        (["1", "-20", " 3 ", None, "null"], "integer"),
        (["1", "2.5", "1e3"], "decimal"),
        (["yes", "No", "TRUE", "f"], "boolean"),
        (["2024-02-29", "2023-01-01"], "date"),
        (["20240229", "19991231", ""], "date"),
        (["12345678", "20240101"], "integer"),
        (["2024-02-29 10:00:00", "2024-03-01"], "timestamp"),
        (["2023-02-29"], "text"),
        (["a", "1"], "text"),
        ([None, "NULL"], "text"),
        ([], "text"),
    ],
)
def test_types(spark, values, kind):
    assert found(spark, values).type == kind if values else I.infer(I.format_counts(frame(spark, values))) == {}


def test_planted_formats_have_exact_counts(spark):
    values = ["01/02/2024"] * 7 + ["25/12/2024"] * 3 + ["2024-05-06"] * 5 + ["31/02/2024"] * 2 + [None] * 4
    counts = {tuple(r["candidates"]) if r["candidates"] is not None else None: r["n"] for r in I.format_counts(frame(spark, values)).collect()}
    assert counts == {("dd/MM/yyyy", "MM/dd/yyyy"): 7, ("dd/MM/yyyy",): 3, ("yyyy-MM-dd",): 5, (): 2, None: 4}
    got = found(spark, values, tolerance=0.2)
    assert got.type == "date" and got.unread == 2 and got.ambiguous == 0
    assert got.counts == {"yyyy-MM-dd": 5, "dd/MM/yyyy": 10}
    assert found(spark, values).type == "text"


def test_unmistakable_values_decide_the_order(spark):
    american = found(spark, ["01/02/2024", "12/25/2024"])
    assert american.formats == ("MM/dd/yyyy",)
    both = found(spark, ["01/02/2024", "12/25/2024", "12/26/2024", "25/12/2024"])
    assert both.formats == ("MM/dd/yyyy", "dd/MM/yyyy") and both.ambiguous == 1


def test_typed_columns(spark):
    df = spark.createDataFrame(
        [("25/12/2024", "1", "yes", 1), ("01/02/2024", " 2.5", "off", 2), ("null", "", None, 3), ("2024-03-04", "x", "maybe", 4)],
        "`a.b` string, n string, f string, other int",
    )
    types = I.infer(I.format_counts(df, ["a.b"]))
    types |= {"n": I.Inferred("decimal"), "f": I.Inferred("boolean")}
    got = [tuple(r) for r in I.typed(df, types).collect()]
    assert got == [
        (dt.date(2024, 12, 25), 1.0, True, 1), (dt.date(2024, 2, 1), 2.5, False, 2), (None, None, None, 3),
        (dt.date(2024, 3, 4), None, None, 4),
    ]
    times = frame(spark, ["2024-01-02 03:04:05", "2024-01-02"])
    (a,), (b,) = I.typed(times, I.infer(I.format_counts(times))).collect()
    assert a == dt.datetime(2024, 1, 2, 3, 4, 5) and b == dt.datetime(2024, 1, 2)


def test_no_shuffle_of_values(spark, sf_dir):
    """Only counted sets are shuffled."""
    df = spark.range(10).select(F.col("id").cast("string").alias("v"))
    plan = I.format_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(column_name" in plan
    assert I.format_counts(spark.range(3)).collect() == []
