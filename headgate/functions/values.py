"""Cell-level conversions as built-in column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.functions.fitting import resized, text_as

MICROS_PER_DAY = 86_400_000_000

# The characters that count as white space around a field.
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The kinds a cell can have in a change record.
NULL_KIND = "NullVal"
INT32_KIND = "Int32Val"
INT64_KIND = "Int64Val"
FLOAT_KIND = "FloatVal"
DOUBLE_KIND = "DoubleVal"
BOOL_KIND = "BoolVal"
MICROS_KIND = "TimestampMicros"
STRING_KIND = "StringVal"


def value_kind(dtype: T.DataType) -> str:
    """Kind of a non-null cell, from the column's type alone."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return INT32_KIND
    if isinstance(dtype, T.LongType):
        return INT64_KIND
    if isinstance(dtype, T.FloatType):
        return FLOAT_KIND
    if isinstance(dtype, T.DoubleType):
        return DOUBLE_KIND
    if isinstance(dtype, T.BooleanType):
        return BOOL_KIND
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return MICROS_KIND
    return STRING_KIND


def epoch_micros(c: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970. Zone-less values never pass through the session zone."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint") * F.lit(MICROS_PER_DAY)
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(c)
    return F.unix_micros(c)


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, from its own calendar fields.

    `timestampdiff` would convert both sides to instants in the session zone first.
    """
    minutes = F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def ntz_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def plain_decimal(c: Column) -> Column:
    """Shortest plain text of an exact decimal: no exponent, no trailing zeros.

    Outside ANSI mode Spark's own text of a small decimal has an exponent, `1.5E-9`: its digits then
    stand after as many zeros as the exponent says, less one.
    """
    text = c.cast("string")
    power = lambda i: F.regexp_extract(text, r"^(-?)([0-9])[.]?([0-9]*)E-([0-9]+)$", i)
    zeros = F.repeat(F.lit("0"), F.when(power(4) != "", power(4)).otherwise("1").cast("int") - 1)
    text = F.when(F.contains(text, F.lit("E-")), F.concat(power(1), F.lit("0."), zeros, power(2), power(3))).otherwise(text)
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def default_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a value that has no kind of its own; nested values become JSON."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(dtype, T.BinaryType):
        return F.translate(F.base64(c), "\r\n", "")
    return c.cast("string")


def canonical_text(c: Column, dtype: T.DataType) -> Column:
    """Text by which a cell of any kind is carried in the long record form."""
    if isinstance(dtype, T.DecimalType):
        return plain_decimal(c)
    if value_kind(dtype) == MICROS_KIND:
        return epoch_micros(c, dtype).cast("string")
    return default_text(c, dtype)


def tagged_value(c: Column, dtype: T.DataType) -> Column:
    """`struct<kind, value>` of a cell; SQL NULL is tagged rather than dropped."""
    return F.struct(
        F.when(c.isNull(), F.lit(NULL_KIND)).otherwise(F.lit(value_kind(dtype))).alias("kind"),
        canonical_text(c, dtype).alias("value"),
    )


def trim_space(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_space(c), F.lit(""))


def resize_integer(c: Column, to: str) -> Column:
    """Widen or narrow an integer; a value out of range becomes NULL."""
    return resized(c, to)


def lenient_number(c: Column, to: str = "int", default_zero: bool = False) -> Column:
    """Trimmed text as a number; text that is no number becomes NULL, or 0 on request."""
    parsed = text_as(trim_space(c), to)
    return F.coalesce(parsed, F.lit(0).cast(to)) if default_zero else parsed


def base_name(path: Column) -> Column:
    """Last segment of a path, trailing slashes ignored; '.' for '' and '/' for a bare root."""
    trimmed = F.regexp_replace(path, "/+$", "")
    return (
        F.when(path == "", F.lit("."))
        .when(trimmed == "", F.lit("/"))
        .otherwise(F.substring_index(trimmed, "/", -1))
    )


def extension(path: Column) -> Column:
    """From the last dot of the last segment, dot included; '' when there is none."""
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


def has_extension(ext: Column, allowed: list[str]) -> Column:
    return F.lower(ext).isin([a.lower() for a in allowed])


def parse_list(c: Column, sep: str = ",") -> Column:
    """Delimited text as an array: parts trimmed, empty parts and 'NULL' left out."""
    parts = F.transform(F.split(c, re.escape(sep)), trim_space)
    return F.filter(parts, lambda x: (x != "") & (x != "NULL"))


#: Magnitudes below which a value is summed with twelve decimals, and below which as a whole number.
WITH_DECIMALS, WHOLE = 1e16, 1e27


def exact_sum(c: Column) -> Column:
    """Sum as a double that does not depend on the order of addition, whatever the magnitudes up to 1e27.

    Doubles of 1e16 and more have no decimals, so they are summed as whole numbers and the others
    with twelve decimals, both exactly. Larger ones, infinities and NaN are added as doubles: a NaN
    makes the sum NaN. Nulls are left out; without a value the sum is null.
    """
    size = F.abs(c.cast("double"))
    small, large = size < WITH_DECIMALS, (size >= WITH_DECIMALS) & (size < WHOLE)
    parts = [
        F.sum(F.when(small, c).cast("decimal(28,12)")).cast("double"),
        F.sum(F.when(large, c).cast("decimal(28,0)")).cast("double"),
        F.sum(F.when(size >= WHOLE, c).cast("double")),
    ]
    return F.when(F.count(c) > 0, sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)))
