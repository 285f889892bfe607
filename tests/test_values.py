import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.functions import fitting
from headgate.functions import values as V
from headgate.functions.fitting import fitted, has_cast, json_value_as, text_as
from headgate.functions.typenames import (
    field_type,
    logical_type,
    source_field_type,
    struct_from_json_schema,
)
from headgate.operators.envelope import kind_counts, to_cells, to_envelope
from headgate.operators.schema import Field, apply_schema, conformance_report, dynamic_to_typed, typed_to_dynamic

TYPED = (
    "id INT, big_number BIGINT, small_number SMALLINT, name STRING, is_active BOOLEAN, price DECIMAL(10,2), "
    "weight FLOAT, rating DOUBLE, created_at TIMESTAMP_NTZ, notes STRING"
)
AT = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)


@pytest.fixture(scope="module")
def typed(spark):
    rows = [
        (1, 9223372036854775807, 100, "Test Product", True, Decimal("99.99"), 2.5, 4.75, AT, "Test notes"),
        (999, None, None, "Null Test", None, None, None, None, None, None),
        (-2147483648, -9223372036854775808, -32768, "", False, Decimal("0.10"), -0.0, float("nan"), dt.datetime(1969, 12, 31, 23, 59, 59, 1), ""),
    ]
    return spark.createDataFrame(rows, TYPED)


@pytest.fixture(scope="module")
def cells(typed):
    return {(r.key, r.column): (r.kind, r.value) for r in to_cells(typed, "test_data_types", "id").collect()}


@pytest.mark.parametrize(
    ("column", "kind", "value"),
    [
        ("id", "Int32Val", "1"),
        ("big_number", "Int64Val", "9223372036854775807"),
        ("small_number", "Int32Val", "100"),
        ("name", "StringVal", "Test Product"),
        ("is_active", "BoolVal", "true"),
        ("price", "StringVal", "99.99"),
        ("weight", "FloatVal", "2.5"),
        ("rating", "DoubleVal", "4.75"),
        ("created_at", "TimestampMicros", str(1714979289123456)),
        ("notes", "StringVal", "Test notes"),
    ],
)
def test_each_type_has_its_kind(cells, column, kind, value):
    assert cells["1", column] == (kind, value)


@pytest.mark.parametrize("column", ["big_number", "small_number", "is_active", "price", "weight", "rating", "created_at", "notes"])
def test_null_is_tagged(cells, column):
    assert cells["999", column] == ("NullVal", None)


def test_edge_values(cells):
    edge = "-2147483648"
    assert cells[edge, "big_number"] == ("Int64Val", "-9223372036854775808")
    assert cells[edge, "small_number"] == ("Int32Val", "-32768")
    assert cells[edge, "price"] == ("StringVal", "0.1")
    assert cells[edge, "rating"] == ("DoubleVal", "NaN")
    assert cells[edge, "created_at"] == ("TimestampMicros", "-999999")
    assert cells[edge, "notes"] == ("StringVal", "")


def test_envelope(typed):
    row = to_envelope(typed, "test_data_types").where("data.id = 1").first()
    assert (row.entity, row.op, row.data.name) == ("test_data_types", "UPSERT", "Test Product")


def test_kind_counts(typed):
    counts = {(r.column, r.kind): r.cells for r in kind_counts(typed).collect()}
    assert counts["notes", "NullVal"] == 1 and counts["notes", "StringVal"] == 2 and counts["id", "Int32Val"] == 3


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "plain"),
    [("1.50", "1.5"), ("100.00", "100"), ("-0.05", "-0.05"), ("0.00", "0"), ("100", "100"), ("1200.00", "1200")],
)
def test_plain_decimal(spark, text, plain):
    scale = len(text.partition(".")[2])
    assert one(spark, V.plain_decimal(F.lit(text).cast(f"decimal(20,{scale})"))) == plain


def test_plain_decimal_has_no_exponent(spark):
    assert one(spark, V.plain_decimal(F.lit("100000000000000000000").cast("decimal(38,0)"))) == "100000000000000000000"
    assert one(spark, V.plain_decimal(F.lit("0.000000010").cast("decimal(38,18)"))) == "0.00000001"


def test_micros_do_not_depend_on_the_session_zone(spark):
    day, at = F.lit("2024-03-31").cast("date"), F.lit("2024-03-31 02:30:00").cast("timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert one(spark, V.epoch_micros(day, T.DateType())) == 1711843200000000
        assert one(spark, V.epoch_micros(at, T.TimestampNTZType())) == 1711852200000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    ("path", "name", "ext"),
    [
        ("a/b/part.STEP", "part.STEP", ".STEP"),
        ("a.b/c", "c", ""),
        ("x.tar.gz", "x.tar.gz", ".gz"),
        ("a/b/", "b", ""),
        ("", ".", ""),
        ("///", "/", ""),
        (".hidden", ".hidden", ".hidden"),
        ("dir/dot.", "dot.", "."),
    ],
)
def test_path_parts(spark, path, name, ext):
    assert one(spark, V.base_name(F.lit(path))) == name
    assert one(spark, V.extension(F.lit(path))) == ext


def test_extension_filter_ignores_case(spark):
    exts = spark.createDataFrame([(e,) for e in [".step", ".STP", ".pdf", ".steps", ""]], "e STRING")
    assert [r.e for r in exts.where(V.has_extension(F.col("e"), [".step", ".stp"])).collect()] == [".step", ".STP"]


def test_list_parse_and_blanks(spark):
    assert one(spark, V.parse_list(F.lit(" a, b\t,,NULL , null,c "))) == ["a", "b", "null", "c"]
    assert one(spark, V.parse_list(F.lit(""))) == []
    assert one(spark, V.blank_to_null(F.lit(" \t\n"))) is None
    assert one(spark, V.blank_to_null(F.lit(" x "))) == "x"


TEXTS = [
    "12", " 12 ", "+12", "-12", "12.5", "", " ", "abc", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "32767", "32768",
    "1e3", "1E400", "NaN", "Infinity", "-inf", ".5", "5.", ".", "e5", "true", "T", "no", "0", "1", "0000000000000000000012",
    "2024-01-02", "2024-01-02 03:04:05", None,
]


@pytest.mark.parametrize("to", ["smallint", "int", "bigint", "float", "double", "boolean", "decimal(38,9)", "date", "timestamp_ntz"])
def test_text_fits_exactly_when_a_cast_succeeds(spark, to):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t STRING")
    mine, cast = text_as(F.col("t"), to).cast("string"), F.col("t").try_cast(to).cast("string")
    rows = df.select("t", mine.alias("a"), cast.alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]


@pytest.mark.parametrize("to", ["tinyint", "smallint", "int", "bigint"])
@pytest.mark.parametrize("source", ["bigint", "int", "double", "decimal(38,4)"])
def test_numbers_fit_exactly_when_a_cast_succeeds(spark, source, to):
    values = ["0", "127", "128", "-128", "-129", "32767.9", "-32768.9", "32768", "2147483647.9", "2147483648", "-2147483648.9",
              "-2147483649", "9007199254740993", "1e17", None]
    df = spark.createDataFrame([(v,) for v in values], "t STRING")
    df = df.select(F.col("t").try_cast("decimal(38,4)").try_cast(source).alias("v"))
    rows = df.select(fitted(F.col("v"), df.schema["v"].dataType, to).alias("a"), F.col("v").try_cast(to).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_types_without_a_cast(spark):
    assert not has_cast(T.DoubleType(), "date") and not has_cast(T.DateType(), "int")
    assert has_cast(T.StringType(), "date") and has_cast(T.DateType(), "timestamp_ntz")
    assert one(spark, fitted(F.lit(1.5), T.DoubleType(), "date")) is None


def test_lenient_numbers(spark):
    assert one(spark, V.lenient_number(F.lit(" 12 "))) == 12
    assert one(spark, V.lenient_number(F.lit("x"))) is None
    assert one(spark, V.lenient_number(F.lit("x"), default_zero=True)) == 0
    assert one(spark, V.lenient_number(F.lit(" 1.5 "), "double")) == 1.5


@pytest.mark.parametrize(
    ("text", "to", "value"),
    [("3.9", "int", 3), ("-3.9", "bigint", -3), ("1e3", "int", 1000), ("true", "boolean", True), ("yes", "boolean", None),
     ("x", "int", None), ("2", "double", 2.0), ("3000000000", "int", None), ('{"a":1}', "string", '{"a":1}')],
)
def test_json_scalars(spark, text, to, value):
    assert one(spark, json_value_as(F.lit(text), to)) == value


@pytest.mark.parametrize(
    ("source", "logical", "spark_type"),
    [
        ("int4", "INTEGER", "int"), ("bigint", "BIGINT", "bigint"), ("int2", "SMALLINT", "smallint"), ("real", "FLOAT", "float"),
        ("double precision", "DOUBLE", "double"), ("bool", "BOOLEAN", "boolean"), ("date", "DATE", "date"),
        ("time without time zone", "TIME", "string"), ("timestamp", "TIMESTAMP", "timestamp_ntz"),
        ("timestamptz", "TIMESTAMP_WITH_TZ", "timestamp"), ("uuid", "UUID", "string"), ("jsonb", "JSONB", "string"),
        ("numeric", "DECIMAL", "decimal(38,9)"), ("bytea", "BINARY", "binary"), ("character varying", "STRING", "string"),
        ("varchar[]", "STRING", "array<string>"), ("integer[]", "ARRAY", "array<int>"), ("numeric(20,13)", "DECIMAL", "decimal(20,13)"),
        ("numeric(38)", "DECIMAL", "decimal(38,0)"), ("decimal( 5 , 2 )", "DECIMAL", "decimal(5,2)"), ("numeric(60,2)", "DECIMAL", "string"), ("numeric(3,-2)", "DECIMAL", "string"),
        ("text[][]", "ARRAY", "array<array<string>>"), ("numeric(9,2)[]", "ARRAY", "array<decimal(9,2)>"), ("varchar(20)", "STRING", "string"), ("mood", "ENUM", "string"),
        ("ARRAY", "ENUM", "string"), ("interval", "ENUM", "string"), ("text", "TEXT", "string"), ("bit varying", "TEXT", "string"),
    ],
)
def test_source_type_names(source, logical, spark_type):
    assert (logical_type(source), source_field_type(source)) == (logical, spark_type)


def test_declared_fields():
    names = ["varchar", "int32", "int64", "float32", "float64", "bool", "timestamp", "date", "bytes", "no such type"]
    types = ["string", "int", "bigint", "float", "double", "boolean", "timestamp_ntz", "date", "binary", "string"]
    assert [field_type(n) for n in names] == types


def test_apply_schema_keeps_declared_order(spark):
    df = spark.createDataFrame([("7", "x", "2024-01-02")], "id STRING, name STRING, d STRING")
    out = apply_schema(df, {"d": "date", "absent": "int64", "id": "int64", "name": "int"})
    assert out.dtypes == [("d", "date"), ("absent", "bigint"), ("id", "bigint"), ("name", "int")]
    assert tuple(out.first()) == (dt.date(2024, 1, 2), None, 7, None)


def test_json_schema():
    struct = struct_from_json_schema('{"properties": {"b": {"type": "number"}, "a": {"type": "integer"}, "skip": 5}}')
    assert struct.simpleString() == "struct<b:double,a:bigint>"
    with pytest.raises(ValueError, match="unsupported"):
        struct_from_json_schema('{"properties": {"a": {"type": "array"}}}')
    with pytest.raises(ValueError, match="properties"):
        struct_from_json_schema("{}")


def test_dynamic_round_trip(typed):
    fields = {"id": "int", "big_number": "int64", "name": "string", "is_active": "bool", "rating": "double"}
    back = dynamic_to_typed(typed_to_dynamic(typed.select(*fields).where("id > 0")), "row", fields)
    assert sorted(back.collect()) == sorted(typed.select(*fields).where("id > 0").collect())


def test_conformance(spark):
    df = spark.createDataFrame([(1, None, "7"), (2, "x", "y"), (None, "z", None)], "id INT, name STRING, n STRING")
    report = conformance_report(df, [Field("id", "int", False), Field("name", "string"), Field("n", "int"), Field("gone", "date")])
    assert {(r.column, r.rule): r.violations for r in report.collect()} == {
        ("id", "uncastable"): 0, ("id", "null_in_non_null"): 1, ("name", "uncastable"): 0,
        ("n", "uncastable"): 1, ("gone", "missing"): 3,
    }


def test_names_with_dots_and_separators_that_mean_something_elsewhere(spark):
    from headgate.functions.tokens import lsn_sort_key
    from headgate.functions.values import parse_list
    from headgate.operators.aggregates import ordered_text
    from headgate.operators.schema import apply_schema, dynamic_to_typed

    df = spark.createDataFrame([('{"a.b": 1, "c": {"d": 2}}', "x|y", "0/16B3748", 1)], "j STRING, l STRING, p STRING, `q.r` INT")
    row = dynamic_to_typed(df.select("j"), "j", {"a.b": "integer", "c.d": "integer"}).first()
    assert (row[0], row[1]) == (1, None)
    assert apply_schema(df, {"q.r": "bigint"}).first()[0] == 1
    assert df.select(parse_list(F.col("l"), "|")).first()[0] == ["x", "y"]
    keys = df.select(lsn_sort_key(F.col("p")), lsn_sort_key(F.lit("123456789/0")), lsn_sort_key(F.lit("no"))).first()
    assert tuple(keys) == ("00000000016B3748", None, None)
    both = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "g INT, v STRING, o INT")
    assert ordered_text(both, ["g"], "v", "o", "t", "'\\").first().t == "a'\\b"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plain_decimal_in_both_modes(spark, ansi):
    cases = {"0.000000001": 9, "-0.000000012300": 12, "0": 12, "1.500": 3, "-100": 0, "123456789.000000001": 9, "0.00000": 5}
    want = ["0.000000001", "-0.0000000123", "0", "1.5", "-100", "123456789.000000001", "0"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cells = [V.plain_decimal(F.col(f"c{i}")).alias(f"t{i}") for i in range(len(cases))]
        row = spark.range(1).select(*[F.lit(t).cast(f"decimal(38,{s})").alias(f"c{i}") for i, (t, s) in enumerate(cases.items())]).select(*cells)
        assert list(row.first()) == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_sums_of_any_size(spark):
    rows = [("a", 1e13), ("a", 0.00000001), ("a", 0.1), ("b", float("nan")), ("b", 1.0), ("c", 1e17), ("c", 0.5), ("c", 1e27), ("d", None), ("e", float("inf")), ("e", -2.0)]
    got = {r.k: r.s for r in spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(V.exact_sum(F.col("v")).alias("s")).collect()}
    assert got["a"] == 1e13 + 0.10000001 and math.isnan(got["b"]) and got["c"] == 1e17 + 0.5 + 1e27 and got["d"] is None and got["e"] == float("inf")
    from headgate.operators.aggregates import histogram
    from headgate.plans.splits import range_splits

    rows = spark.createDataFrame([(i, v, "x") for i, (_, v) in enumerate(rows)], "id long, v double, k string")
    whole = {r.le: (r.bucket, r["count"]) for r in histogram(rows, ["k"], "v", [1, 100]).collect()}
    assert whole == {"1": (5, 10), "100": (5, 10), "+Inf": (10, 10)}
    assert [r.row_count for r in range_splits(rows, "id", 2).report(rows, "v").orderBy("split_id").collect()] == [5, 6]


def test_array_texts(spark):
    cases = [
        ("{1,2,NULL,x, 4 }", "integer[]", [1, 2, None, None, 4]), ("{}", "integer[]", []), ('{"a, b",NULL,"NULL","q\\"\\\\z",plain text,""}', "text[]", ["a, b", None, "NULL", 'q"\\z', "plain text", ""]),
        ("{{a,b},{c}}", "text[][]", [["a", "b"], ["c"]]), ("no array", "text[]", None), (None, "text[]", None), ('{"open}', "text[]", None), ("{1.5,12345678901234567890.1234567890123}", "numeric(33,13)[]", [Decimal("1.5"), Decimal("12345678901234567890.1234567890123")]),
        ('{"line\nbreak",é😀}', "text[]", ["line\nbreak", "é😀"]), ("{t,f,NULL}", "boolean[]", [True, False, None]), ("{a,}", "text[]", None),
    ]
    for text, name, want in cases:
        df = spark.createDataFrame([(text,)], "v STRING")
        assert apply_schema(df, {"v": name}, source_field_type).first()[0] == want, text


def test_plain_array_texts_are_read_as_by_tokens(spark, monkeypatch):
    some, pieces = random.Random(5), ["{", "}", ",", '"', "a b", " ", "NULL", "null ", "nullx", "\\", '\\"', '"x, y"', '"NULL"', '"{"', "[", "é", "\t", "7", '"\\q"', "$1"]
    texts = ["{" + ",".join(some.choices(["1", '"a, \\"b\\""', "NULL", " c d ", '"NULL"', "{x}", '"\\\\"', ""], k=some.randrange(5))) + "}" for _ in range(300)]
    texts += ["{" + "".join(some.choices(pieces, k=some.randrange(7))) + "}" for _ in range(700)] + ["{" + "x," * 600 + "y}", "{\0}"]
    df = spark.createDataFrame([(t,) for t in texts], "v STRING")
    assert df.where((F.length("v") <= fitting.SHORT_ARRAY) & F.col("v").rlike(fitting.PLAIN_ARRAY)).count() > 300
    got = [[r[0] for r in apply_schema(df, {"v": name}, source_field_type).collect()] for name in ("text[]", "text[][]", "integer[]")]
    monkeypatch.setattr(fitting, "SHORT_ARRAY", -1)
    assert got == [[r[0] for r in apply_schema(df, {"v": name}, source_field_type).collect()] for name in ("text[]", "text[][]", "integer[]")]


def test_parameterised_numbers_lose_nothing(spark):
    digits = "123456789012345678901234567890"
    df = spark.createDataFrame([(digits, "1234567.1234567890123", "9" * 60)], "a STRING, b STRING, c STRING")
    row = apply_schema(df, {"a": "numeric(38,0)", "b": "numeric(20,13)", "c": "numeric(70,2)"}, source_field_type).first()
    assert list(row) == [Decimal(digits), Decimal("1234567.1234567890123"), "9" * 60]
