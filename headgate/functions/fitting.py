"""Values as another type, NULL where they do not fit.

`try_cast` raises and catches an exception for every value that does not fit, which makes a
column of misfits 50 times slower than one of good values. Here a pattern or a range test
decides first, so that the cast itself practically never fails.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.functions.tokens import replaced

# Largest value of each integer type.
INTEGER_MAX = {"tinyint": 127, "smallint": 32_767, "int": 2_147_483_647, "bigint": 9_223_372_036_854_775_807}

# Text forms of numbers and truth values.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_NUMBER = r"^(?i)([+-]?inf|[+-]?infinity|nan)$"
TRUE_TEXT = ["t", "true", "y", "yes", "1"]
FALSE_TEXT = ["f", "false", "n", "no", "0"]
PADDING = "".join(chr(i) for i in range(1, 33))


def resized(c: Column, to: str) -> Column:
    """An integer as another integer type."""
    top = INTEGER_MAX[to]
    return c.cast(to) if to == "bigint" else F.when(c.between(-top - 1, top), c).cast(to)


def truncated(c: Column, to: str) -> Column:
    """A decimal or floating value as an integer type, truncated toward zero."""
    edge = F.lit(float(INTEGER_MAX[to] + 1))
    fits = (c > -edge - 1) & (c < edge) if to != "bigint" else (c >= -edge) & (c < edge)
    return F.when(fits, c).cast(to)


def text_as_integer(c: Column, to: str) -> Column:
    """Digits decide: with fewer than the largest value has, the number always fits."""
    top = INTEGER_MAX[to]
    digits = len(str(top))
    wide = c.try_cast("decimal(20,0)")
    return F.when(c.rlike(f"^[+-]?0*[0-9]{{1,{digits - 1}}}$"), c.try_cast(to)).when(
        c.rlike(f"^[+-]?0*[0-9]{{{digits}}}$") & wide.between(-top - 1, top), c.try_cast(to)
    )


def text_as(c: Column, to: str) -> Column:
    """Text as another type; white space around it is ignored."""
    target = T.DataType.fromDDL(to)
    text = F.btrim(c, F.lit(PADDING))
    if isinstance(target, T.IntegralType):
        return text_as_integer(text, to)
    if isinstance(target, T.FractionalType):
        form = text.rlike(NUMBER)
        if not isinstance(target, T.DecimalType):
            form = form | text.rlike(SPECIAL_NUMBER)
        return F.when(form, text.try_cast(to))
    if isinstance(target, T.BooleanType):
        low = F.lower(text)
        return F.when(low.isin(TRUE_TEXT), F.lit(True)).when(low.isin(FALSE_TEXT), F.lit(False))
    return c.try_cast(to)


# Fixed value: what the text of an array is made of: braces, commas, quoted and plain elements.
ARRAY_TOKEN = r'[{},]|"(?:[^"\\]|\\.)*"|[^{},"]+'

# Short texts that need no look at single tokens (no brace in quotes, a backslash only in
# quotes and only before a quote or a backslash), their quoted elements and NULLs, and all their elements.
QUOTED = r'[^"\\{}\x00]*+(?:\\["\\][^"\\{}\x00]*+)*+'
PLAIN_ARRAY = rf'^\{{(?:[{{}},]|"{QUOTED}"|[^{{}},"\\\x00]++)*+$'
MARKED = rf'("{QUOTED}")|(?<![^{{}},"]) *+(?i:null) *+(?![^{{}},"])'
ELEMENT = rf'"({QUOTED})"\x00|([^{{}},"\x00 ](?:[^{{}},"\x00]*[^{{}},"\x00 ])?)'
#: Java's patterns repeat groups on the stack, so longer texts go by tokens.
SHORT_ARRAY = 1_000


def _plain_array_json(c: Column) -> Column:
    """JSON of a text that `PLAIN_ARRAY` matches: a NUL marks quoted elements and stands for NULL."""
    marked = F.regexp_replace(c, F.lit(MARKED), F.lit("$1\0"))
    return replaced(F.regexp_replace(marked, F.lit(ELEMENT), F.lit('"$1$2"')), ("\0", "null"), ("{", "["), ("}", "]"))


def _json_text(text: Column) -> Column:
    return F.concat(F.lit('"'), replaced(text, ("\\", "\\\\"), ('"', '\\"')), F.lit('"'))


def array_text_as(c: Column, to: str) -> Column:
    """The text of an array, `{1,NULL,"a, b"}`, as an array of any depth; NULL if it is none.

    Elements in quotes are text whatever they look like; a backslash stands before a quote or a
    backslash. Elements that do not fit the type are NULL, as the element NULL is.
    """
    tokens = F.regexp_extract_all(c, F.lit(f"(?s)({ARRAY_TOKEN})"), F.lit(1))

    def json(token: Column) -> Column:
        inner = F.regexp_replace(F.substr(token, F.lit(2), F.length(token) - 2), r"(?s)\\(.)", "$1")
        plain = F.btrim(token)
        return (
            F.when(token == "{", "[").when(token == "}", "]").when(token == ",", ",").when(F.startswith(token, F.lit('"')), _json_text(inner))
            .when(F.upper(plain) == "NULL", "null").when(plain == "", "").otherwise(_json_text(plain))
        )

    depth = to.count("array<")
    element = to[6 * depth : len(to) - depth]
    texts = "array<" * depth + "string" + ">" * depth
    # Every character belongs to a token, else the text is no array.
    whole = (F.array_join(tokens, "") == c) & c.rlike(r"(?s)^\s*\{.*\}\s*$")
    plain = (F.length(c) <= SHORT_ARRAY) & c.rlike(PLAIN_ARRAY) & c.endswith("}")
    body = F.when(plain, _plain_array_json(c)).when(whole, F.array_join(F.transform(tokens, json), ""))
    parsed = F.from_json(body, texts, {"allowUnquotedControlChars": "true"})

    def fit(value: Column, level: int) -> Column:
        return F.transform(value, lambda x: fit(x, level - 1)) if level else text_as(value, element) if element != "string" else value

    return fit(parsed, depth)


def has_cast(dtype: T.DataType, to: str) -> bool:
    """Whether values of the one type can become values of the other at all."""
    target = T.DataType.fromDDL(to)
    families = (T.NumericType, T.BooleanType), (T.DateType, T.TimestampType, T.TimestampNTZType), (T.BinaryType,)
    if isinstance(dtype, T.StringType) or isinstance(target, T.StringType) or dtype == target:
        return True
    return any(isinstance(dtype, f) and isinstance(target, f) for f in families)


def fitted(c: Column, dtype: T.DataType, to: str) -> Column:
    """A value of a known type as another type."""
    target = T.DataType.fromDDL(to)
    if dtype == target:
        return c
    if not has_cast(dtype, to):
        return F.lit(None).cast(to)
    if isinstance(dtype, T.StringType):
        return array_text_as(c, to) if isinstance(target, T.ArrayType) else text_as(c, to)
    if isinstance(target, T.IntegralType):
        if isinstance(dtype, T.IntegralType):
            return resized(c, to)
        if isinstance(dtype, T.FractionalType):
            return truncated(c, to)
    return c.try_cast(to)


def json_value_as(text: Column, to: str) -> Column:
    """Text of a JSON scalar as another type: numbers cross-cast, truncating toward zero."""
    target = T.DataType.fromDDL(to)
    if isinstance(target, T.IntegralType):
        fraction = F.when(text.rlike(NUMBER), text.try_cast("decimal(38,9)"))
        return F.coalesce(text_as_integer(text, to), truncated(fraction, to))
    if isinstance(target, T.BooleanType):
        return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
    return text if isinstance(target, T.StringType) else text_as(text, to)
