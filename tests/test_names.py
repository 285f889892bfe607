"""Columns whose names hold dots and quotes, through every operator of schemas and constraints."""

from headgate.functions.names import unused
from headgate.operators import constraints as K
from headgate.operators import schema as Y


def test_any_column_name(spark):
    df = spark.sql("SELECT 1L AS `a.b`, '2' AS `c``d`, '{\"x.y\": 3, \"_row\": 4}' AS `j.s`, 5 AS `_row`")
    schema = '{"properties": {"x.y": {"type": "integer"}}}'
    got = Y.apply_json_schema(df, "j.s", schema)
    assert got.columns == ["a.b", "c`d", "_row", "x.y"] and list(got.first()) == [1, "2", 5, 3]
    report = {(r.column, r.rule): r.violations for r in Y.conformance_report(df, [Y.Field("a.b", "int", False), Y.Field("c`d", "boolean")]).collect()}
    assert report == {("a.b", "uncastable"): 0, ("a.b", "null_in_non_null"): 0, ("c`d", "uncastable"): 1, ("j.s", "extra"): 1, ("_row", "extra"): 1}
    assert [tuple(r) for r in Y.fallback_report(df, {"a.b": "int", "c`d": "date"}).collect()] == [("a.b", "int", 1, 0), ("c`d", "date", 1, 1)]
    assert K.key_report(df.union(df), ["a.b", "c`d"], "t").first().asDict() == {
        "entity": "t", "key": "a.b,c`d", "row_count": 2, "distinct_keys": 1, "repeated_keys": 1, "null_rows": 0, "is_key": False}
    assert K.duplicates(df.union(df), ["a.b"]).first().copies == 2
    child = spark.sql("SELECT 7L AS `p.q`")
    assert K.orphans(K.ForeignKey("f", child, ["p.q"], df, ["a.b"])).first().asDict() == {"k0": 7, "rows": 1}
    assert unused(df, "_row") == "__row" and unused(df, "row") == "row"


def test_composite_keys_do_not_clash(spark):
    rows = spark.createDataFrame([("a:", "1", 1), ("a", ":1", 2), ("1:a", "", 3), ("", "1:a", 4), (None, "x", 5), ("é😀", "b", 6)], "`x.1` string, y string, n long")
    edges = K.relationship_edges([K.Relation("s", "d", rows, "n", ["x.1", "y"])]).collect()
    assert {r.src_key: r.dst_key for r in edges} == {"1": "2:a:1:1", "2": "1:a2::1", "3": "3:1:a0:", "4": "0:3:1:a", "6": "2:é😀1:b"}
