"""Cleaning rules and type mapping."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean as C
from tidemark.functions.casts import cast_text, date_guard
from tidemark.functions.types import ColumnSpec, default_value, shape_of, struct_of, target_type
from tidemark.operators import shape as S


def apply(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


TOKENS = ["", " ", "nan", "None", "NULL", "null"]


@pytest.mark.parametrize(
    "rule", [C.clean_null, C.clean_int, C.clean_int_strict, C.clean_bool, C.clean_float]
)
def test_null_tokens(spark, rule):
    assert apply(spark, rule, [*TOKENS, None]) == [None] * 7


def test_null_tokens_are_exact_for_text(spark):
    values = [" nan", "Null", "  ", "NONE", "x"]
    assert apply(spark, C.clean_null, values) == values


def test_tokens_with_whitespace_are_null_for_integers(spark):
    assert apply(spark, C.clean_int, ["\tnan ", " null\n", " ", "  "]) == [None] * 4


# raw, clean_int, clean_int_strict, clean_int_exact
INTEGERS = [
    ("12", "12", "12", "12"),
    (" 12 ", "12", "12", "12"),
    ("\t12 ", "12", "12", "12"),
    ("1.0", "1", "1", "1"),
    ("1.5", "1", "1", "1.5"),
    ("-3.9", "-3", "-3", "-3.9"),
    ("-0.9", "0", "0", "-0.9"),
    ("-2.0", "-2", "-2", "-2"),
    ("1e3", "1e3", "1e3", "1e3"),
    ("1.5e3", "1500", "1500", "1500"),
    ("007", "007", "007", "007"),
    ("ab.c", "ab.c", None, "ab.c"),
    ("abc", "abc", "abc", "abc"),
    ("1.2.3", "1.2.3", None, "1.2.3"),
    ("9007199254740993.0", "9007199254740993", "9007199254740993", "9007199254740993"),
    ("12345678901234567890.5", "12345678901234567890", "12345678901234567890",
     "12345678901234567890.5"),
]


def test_integers(spark):
    raw, loose, strict, exact = (list(c) for c in zip(*INTEGERS, strict=True))
    assert apply(spark, C.clean_int, raw) == loose
    assert apply(spark, C.clean_int_strict, raw) == strict
    assert apply(spark, C.clean_int_exact, raw) == exact


def test_booleans(spark):
    raw = ["TRUE", " Yes ", "1", "on", "False", "NO", "0", "off", " Maybe", "2"]
    want = ["true"] * 4 + ["false"] * 4 + ["maybe", "2"]
    assert apply(spark, C.clean_bool, raw) == want


def test_floats(spark):
    assert apply(spark, C.clean_float, ["1.5", "-2e3", "x", "1,5", "Infinity"]) == [
        1.5,
        -2000.0,
        None,
        None,
        float("inf"),
    ]


def test_dates(spark):
    day = lambda c: C.to_date(c, "yyyyMMdd")
    assert apply(spark, day, ["20240229", "20250229", "NA", "", "2024-01-01"]) == [
        dt.date(2024, 2, 29),
        None,
        None,
        None,
        None,
    ]
    time = lambda c: C.to_timestamp(c, "yyyy-MM-dd HH:mm:ss")
    assert apply(spark, time, ["2024-01-05 10:20:30", "2024-01-05", "nan"]) == [
        dt.datetime(2024, 1, 5, 10, 20, 30),
        None,
        None,
    ]
    assert apply(spark, C.clean_datetime, ["not a day", "null"]) == ["not a day", None]


def test_named_months_parse_without_a_guard(spark):
    assert date_guard(spark.range(1).select("id").id, "dd MMM yyyy") is None
    named = lambda c: C.to_date(c, "dd MMM yyyy")
    assert apply(spark, named, ["05 Jan 2024", "05 Foo 2024"]) == [dt.date(2024, 1, 5), None]


def test_transforms(spark):
    assert apply(spark, C.integer_text, ["12.00", "0012.0", "1.5", "", "x", None]) == [
        "12", "12", "1.5", None, "x", None,
    ]
    assert apply(spark, C.plain_text, ["0042", "20240131", "20251399", "000", "", "a1", None]) == [
        "42", "2024-01-31", "20251399", "0", None, "a1", None,
    ]
    assert apply(spark, C.decimal_text, ["12.75", "2.5", "3.0", "x", "7", None]) == [
        "13", "3", "3", "x", "7", None,
    ]


@pytest.mark.parametrize(
    "dtype",
    [T.LongType(), T.IntegerType(), T.DoubleType(), T.DecimalType(10, 2), T.BooleanType()],
)
def test_guarded_casts_equal_plain_casts(spark, dtype):
    values = [
        "1", " 1 ", "-1", "+1", "1.", ".5", "1.5", "1e3", "1E+3", "1d", "2F", "abc", "", " ", "-",
        "t", " TRUE", "yes", "N", "0", "on", "Infinity", "-inf", "NaN", "1 2", "0x1F", "\t7\n",
        "99999999999999999999", "1,000", "--1", "1-", None,
    ]
    plain = apply(spark, lambda c: c.try_cast(dtype).cast("string"), values)
    guarded = apply(spark, lambda c: cast_text(c, dtype).cast("string"), values)
    assert guarded == plain


@pytest.mark.parametrize(
    "name, want",
    [
        ("character varying", T.StringType()),
        ("TEXT", T.StringType()),
        ("bigint", T.LongType()),
        ("smallint", T.ShortType()),
        ("integer", T.IntegerType()),
        ("numeric", T.DecimalType(38, 18)),
        ("double precision", T.DoubleType()),
        ("real", T.FloatType()),
        ("date", T.DateType()),
        ("timestamp without time zone", T.TimestampNTZType()),
        ("timestamp with time zone", T.TimestampType()),
        ("boolean", T.BooleanType()),
        ("jsonb", T.StringType()),
        ("uuid", T.StringType()),
        ("interval", T.StringType()),
        ("point", T.StringType()),
        ("bytea", T.StringType()),
    ],
)
def test_target_types(name, want):
    assert target_type(name) == want


def test_numeric_keeps_known_precision():
    assert target_type("numeric", 12, 2) == T.DecimalType(12, 2)


def test_defaults(spark):
    def value(type_, default):
        c = default_value(ColumnSpec("c", type_, default=default), "2025-01-02 03:04:05")
        return spark.range(1).select(c).first()[0]

    assert value("timestamp", "now()") == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert value("date", "CURRENT_TIMESTAMP") == dt.date(2025, 1, 2)
    assert value("boolean", "false") is False
    assert value("integer", "-7") == -7
    assert value("numeric", "1.5") == Decimal("1.5")
    assert value("text", "'it''s'") == "it's"
    assert value("bigint", "nextval('s')") is None
    assert value("text", "'x'::text") is None
    assert value("text", "upper('x')") is None
    assert value("text", None) is None


def test_shape_round_trip(spark):
    df = spark.createDataFrame([], "a bigint, b string, c decimal(9,2), d date, e boolean")
    assert struct_of(shape_of(df.schema)) == df.schema


def test_clean_by_declared_type(spark):
    df = spark.createDataFrame(
        [("1.0", "YES", "null", "x", 5)], "i string, b string, t string, other string, n int"
    )
    shape = [ColumnSpec("i", "integer"), ColumnSpec("b", "boolean"), ColumnSpec("t", "text"),
             ColumnSpec("n", "integer"), ColumnSpec("absent", "text")]
    assert tuple(S.clean(df, shape).first()) == ("1", "true", None, "x", 5)


def test_cast_and_length_limit(spark):
    df = spark.createDataFrame([("12", "abcd"), ("x", "abc")], "n string, t string")
    shape = [ColumnSpec("n", "integer"), ColumnSpec("t", "varchar", max_length=3)]
    assert [tuple(r) for r in S.cast_to(df, shape).collect()] == [(12, None), (None, "abc")]
    report = {r["column_name"]: r for r in S.drift_report(df, shape).collect()}
    assert (report["n"]["cast_failures"], report["t"]["over_long"]) == (1, 1)


def test_drift_of_empty_table_and_missing_column(spark):
    df = spark.createDataFrame([], "n string")
    shape = [ColumnSpec("n", "integer"), ColumnSpec("gone", "text", nullable=False)]
    got = [tuple(r) for r in S.drift_report(df, shape).collect()]
    assert got == [
        ("n", "string", "int", 0, 0, 0, 0),
        ("gone", "missing", "string", 0, 0, 0, 0),
    ]


def test_align(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert S.align(df, ["a", "zz", "b"]).columns == ["a", "b"]
    like = T.StructType.fromDDL("a string, source_version bigint, b int")
    assert tuple(S.align(df, like).first()) == ("x", None, 1)


def test_all_text(spark):
    df = spark.createDataFrame([(1, True, None)], "a int, b boolean, c double")
    assert tuple(S.all_text(df).first()) == ("1", "true", None)


def test_profile_exact_and_estimated(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (2, "a")], "n int, t string")
    want = [("n", 3, 0, 2, "1", "2"), ("t", 3, 1, 2, "a", "b")]
    assert sorted(tuple(r) for r in S.profile(df, exact=True).collect()) == want
    assert sorted(tuple(r) for r in S.profile(df).collect()) == want


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "n int")
    assert [tuple(r) for r in S.profile(df, exact=True).collect()] == [("n", 0, 0, 0, None, None)]


def test_post_clean_check(spark):
    df = spark.createDataFrame([("1.5", " "), ("2", "x")], "i string, t string")
    got = {(r[0], r[1]): r[2] for r in S.post_clean_check(df, ["i"]).collect()}
    assert got == {("i", "decimal_point"): 1, ("i", "blank"): 0, ("t", "blank"): 1}


def test_not_null_violations(spark):
    df = spark.createDataFrame([(i, None if i > 1 else "x") for i in range(8)], "id int, t string")
    (row,) = S.not_null_violations(df, ["id", "t"], ["id"]).collect()
    assert (row["column_name"], row["null_count"]) == ("t", 6)
    assert row["samples"] == [f'{{"id":{i},"t":null}}' for i in (2, 3, 4)]


def test_fill_not_null_only_fills_text(spark):
    df = spark.createDataFrame([(None, None)], "t string, n int")
    assert tuple(S.fill_not_null(df, ["t", "n"]).first()) == ("", None)


def test_quality_report(spark):
    df = spark.createDataFrame([("1.5", None), ("2", "x")], "i string, t string")
    shape = [ColumnSpec("i", "bigint"), ColumnSpec("t", "text")]
    got = sorted(tuple(r) for r in S.quality_report(df, shape).collect())
    assert got == [("i", "decimal_in_integer", "error", 1), ("t", "null_values", "warning", 1)]


def test_hangul_column_names(spark):
    df = spark.createDataFrame([("1.0", " ")], "`티커` string, `국문명` string")
    shape = [ColumnSpec("티커", "integer"), ColumnSpec("국문명", "text")]
    assert tuple(S.clean(df, shape).first()) == ("1", None)


def test_long_integer_text_is_cut_exactly(spark):
    rows = [("123456789012345678901.5", "123456789012345678901"), ("-0.9", "0"), ("0012.7", "12"),
            ("1.9999999999999999999", "1"), ("-" + "9" * 40 + ".0", "-" + "9" * 40), ("x.5", "x.5")]
    df = spark.createDataFrame([(r[0],) for r in rows], "t string")
    got = [r[0] for r in df.select(C.clean_int(F.col("t"))).collect()]
    assert got == [r[1] for r in rows]
    exact = [r[0] for r in df.select(C.clean_int_exact(F.col("t"))).collect()]
    assert exact == [r[0] for r in rows[:4]] + [rows[4][1], "x.5"]
