"""Cleaning rules for text columns, one Column expression each.

All rules are built-in expressions: a table is cleaned in one projection, inside
whole-stage code generation, without a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import cast_text, date_guard

# Text that stands for NULL, and the words for true and false.
NULL_TOKENS = ["", " ", "nan", "None", "NULL", "null"]
TRUE_WORDS = ["true", "1", "yes", "on"]
FALSE_WORDS = ["false", "0", "no", "off"]

# Everything Python's str.strip() removes; SQL trim() alone removes only spaces.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def is_null_token(c: Column) -> Column:
    return c.isin(NULL_TOKENS)


def clean_null(c: Column) -> Column:
    """Null tokens become NULL; other text is unchanged."""
    return F.when(~is_null_token(c), c)


def _trimmed(c: Column) -> Column:
    return clean_null(strip(c))


# Plain decimal text, and such text without a fraction.
PLAIN_DECIMAL = r"^[+-]?0*(\d+)\.\d+$"
PLAIN_WHOLE = r"^[+-]?\d+\.0+$"


def _truncated(text: Column) -> Column:
    """Number text cut toward zero, as integer text; NULL when it is no number.

    Plain decimals are cut as text, exactly, whatever their length. Other forms (exponents)
    are exact up to 20 integer digits and go through a double beyond.
    """
    whole = F.regexp_extract(text, PLAIN_DECIMAL, 1)
    signed = F.when(text.startswith("-") & (whole != "0"), F.concat(F.lit("-"), whole)).otherwise(whole)
    exact = cast_text(text, T.DecimalType(38, 18))
    toward_zero = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
    approx = cast_text(text, T.DoubleType()).try_cast("decimal(38,0)")
    other = F.coalesce(toward_zero.cast("string"), approx.cast("string"))
    return F.when(text.rlike(PLAIN_DECIMAL), signed).otherwise(other)


def clean_int(c: Column) -> Column:
    """Trim, null tokens, ``12.9`` -> ``12``; text that is no number is kept."""
    t = _trimmed(c)
    return F.when(t.contains("."), F.coalesce(_truncated(t), t)).otherwise(t)


def clean_int_strict(c: Column) -> Column:
    """Like :func:`clean_int`, but text with a point that is no number becomes NULL."""
    t = _trimmed(c)
    return F.when(t.contains("."), _truncated(t)).otherwise(t)


def clean_int_exact(c: Column) -> Column:
    """Only whole values (``1.0``) become integers; ``1.5`` is kept."""
    t = _trimmed(c)
    d = cast_text(t, T.DecimalType(38, 18))
    whole = F.when(t.rlike(PLAIN_DECIMAL), t.rlike(PLAIN_WHOLE)).otherwise(d == F.floor(d))
    return F.when(t.contains(".") & whole, _truncated(t)).otherwise(t)


def clean_float(c: Column) -> Column:
    """Null tokens, then a double; NULL when the text is no number."""
    return cast_text(clean_null(c), T.DoubleType())


def clean_datetime(c: Column) -> Column:
    """Null tokens only: text that is no date is kept. See :func:`to_timestamp`."""
    return clean_null(c)


def to_date(c: Column, fmt: str) -> Column:
    """The typed companion of :func:`clean_datetime`: NULL when ``fmt`` does not fit."""
    guard = date_guard(c, fmt)
    day = F.try_to_date(clean_null(c), fmt)
    return day if guard is None else F.when(guard, day)


def to_timestamp(c: Column, fmt: str) -> Column:
    """Like :func:`to_date` for formats with a time of day (zone-less result)."""
    guard = date_guard(c, fmt)
    time = F.try_to_timestamp(clean_null(c), F.lit(fmt)).cast("timestamp_ntz")
    return time if guard is None else F.when(guard, time)


def clean_bool(c: Column) -> Column:
    """Yes/no words become ``true``/``false`` text; other text is lower-cased and kept."""
    t = F.lower(_trimmed(c))
    return (
        F.when(t.isin(TRUE_WORDS), F.lit("true"))
        .when(t.isin(FALSE_WORDS), F.lit("false"))
        .otherwise(t)
    )


def _strip_zeros(digits: Column) -> Column:
    bare = F.ltrim(digits, F.lit("0"))
    return F.when(bare == "", F.lit("0")).otherwise(bare)


def integer_text(c: Column) -> Column:
    """Empty -> NULL; ``12.00`` -> ``12``; everything else unchanged."""
    return F.when(c.rlike(r"^[0-9]+\.[0]+$"), _strip_zeros(F.substring_index(c, ".", 1))).when(
        c != "", c
    )


def plain_text(c: Column) -> Column:
    """Empty -> NULL; ``yyyymmdd`` -> ``yyyy-MM-dd``; digits lose leading zeros.

    The date rule goes first: digits match it too, so the other order would never
    reach it. Eight digits that are no calendar day fall through to the digits rule.
    """
    day = F.when(
        c.rlike(r"^(19|20)[0-9]{6}$"),
        F.try_to_date(c, "yyyyMMdd").cast("string"),
    )
    digits = F.when(c.rlike(r"^[0-9]+$"), _strip_zeros(c))
    return F.coalesce(day, digits, F.when(c != "", c))


def decimal_text(c: Column) -> Column:
    """``12.75`` -> ``13`` as a cast to a whole number rounds; everything else unchanged."""
    whole = F.round(c.try_cast("decimal(38,18)"), 0).cast("decimal(38,0)").cast("string")
    return F.when(c.rlike(r"^[0-9]+\.[0-9]+$"), F.coalesce(whole, c)).otherwise(c)


def rule_for(dtype: T.DataType):
    """The cleaning rule for a column declared as ``dtype``."""
    if isinstance(dtype, T.IntegralType):
        return clean_int
    if isinstance(dtype, T.BooleanType):
        return clean_bool
    return clean_null
