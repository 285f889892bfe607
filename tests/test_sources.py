import os

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from headgate.operators.scan import project
from headgate.sources.handler import SourceHandler, register_handler
from headgate.sources.jdbc import jdbc_scan, range_predicates
from headgate.sources.listing import DOCUMENT_EXTENSIONS, MODEL_EXTENSIONS, list_files
from headgate.sources.manifest import COLUMNS, read_manifest
from headgate.sources.package import MANIFEST_FILE, package_counts, read_package
from headgate.sources.tables import UnknownEntity, full_scan, read_entity
from headgate.plans.splits import RangeSplits

HEADER = ",".join(name for name, _, _ in COLUMNS)
GOOD = "0, ,PN-1,A,Top assembly , 1 ,Assembly,,2.5,,top.step,,"


def manifest(tmp_path, *lines, header=HEADER):
    path = tmp_path / "manifest.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_unknown_entity_and_mode(spark, sd):
    with pytest.raises(UnknownEntity):
        full_scan(spark, sd, "no_such_table")
    with pytest.raises(ValueError, match="mode"):
        read_entity(spark, sd, "orders", "subgraph")
    assert read_entity(spark, sd, "events", "change_stream", limit=7).count() == 7


def test_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    assert project(df, ["c", "a", "zz"]).columns == ["a", "c"]
    assert project(df, []).columns == ["a", "b", "c"]


def test_manifest_rows_are_trimmed_and_typed(spark, tmp_path):
    rows, rejects = read_manifest(spark, manifest(tmp_path, GOOD, 'x,P,PN-2,B,"Plate, flat",?,Component,Al, ,C1,p.stp,d.pdf,drawing'))
    top, plate = rows.orderBy("part_number").collect()
    assert tuple(top) == (0, None, "PN-1", "A", "Top assembly", 1, "Assembly", None, 2.5, None, "top.step", None, None)
    assert (plate.level, plate.qty, plate.weight_kg, plate.nomenclature) == (None, None, None, "Plate, flat")
    assert rejects.count() == 0


def test_manifest_zero_option(spark, tmp_path):
    path = manifest(tmp_path, "x,,PN,A,N,?,T,,,,,,")
    row = read_manifest(spark, path, default_zero=True)[0].first()
    assert (row.level, row.qty, row.weight_kg) == (0, 0, 0.0)


def test_ragged_lines_are_kept_aside(spark, tmp_path):
    rows, rejects = read_manifest(spark, manifest(tmp_path, GOOD, "1,PN-1,short", GOOD.replace("PN-1", "PN-3") + ",extra", GOOD))
    assert [r.part_number for r in rows.collect()] == ["PN-1", "PN-1"]
    assert rows.select("part_number").count() == 2
    assert rejects.count() == 2
    assert sorted(r.line for r in rejects.collect())[1] == "1,PN-1,short"


def test_manifest_width_follows_the_header(spark, tmp_path):
    wide = manifest(tmp_path, GOOD + ",more", GOOD, header=HEADER + ",comment")
    rows, rejects = read_manifest(spark, wide)
    assert (rows.count(), rejects.count(), len(rows.columns)) == (1, 1, 13)
    with pytest.raises(ValueError, match="13 columns"):
        read_manifest(spark, manifest(tmp_path, "1,2", header="a,b"))


def test_listing_filters_by_extension(spark, tmp_path):
    for name, size in [("3D/a.step", 3), ("3D/deep/b.STP", 5), ("3D/c.txt", 1), ("docs/d.PDF", 7), ("docs/e.pdf.bak", 1)]:
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    models = {(r.name, r.size, r.extension) for r in list_files(spark, str(tmp_path), MODEL_EXTENSIONS).collect()}
    assert models == {("a.step", 3, ".step"), ("b.STP", 5, ".STP")}
    documents = list_files(spark, str(tmp_path), DOCUMENT_EXTENSIONS).collect()
    assert [(r.name, r.extension) for r in documents] == [("d.PDF", ".PDF")]
    assert documents[0].modified_micros > 1_600_000_000_000_000
    assert list_files(spark, str(tmp_path)).count() == 5


def test_package(spark, tmp_path):
    (tmp_path / MANIFEST_FILE).write_text(f"{HEADER}\n{GOOD}\n")
    for name in ("3D_Models/a.STEP", "3D_Models/x/b.stp", "3D_Models/readme.md", "Documents/c.pdf"):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    root = str(tmp_path)
    assert dict(package_counts(spark, root).collect()) == {"bom_manifest": 1, "cad_models": 2, "documents": 1}
    assert read_package(spark, root, "bom_manifest").first().part_number == "PN-1"
    assert {r.name for r in read_package(spark, root, "cad_models").collect()} == {"a.STEP", "b.stp"}
    with pytest.raises(UnknownEntity):
        read_package(spark, root, "drawings")
    with pytest.raises(ValueError, match="mode"):
        read_package(spark, root, "documents", "change_stream")


def test_jdbc_predicates():
    splits = RangeSplits("id", 1, 10, 10, 3)
    assert range_predicates(splits) == ['("id" >= 1 AND "id" < 4) OR "id" IS NULL', '"id" >= 4 AND "id" < 7', '"id" >= 7 AND "id" < 11']


class Recorder:
    """Stands in for a session and keeps the arguments of a relational read; no database is needed."""

    def __init__(self):
        self.read = self

    def jdbc(self, *args, **kwargs):
        self.kwargs, self.tasks = kwargs, None
        return self

    def coalesce(self, n):
        self.tasks = n
        return self


@pytest.mark.parametrize("n", [1, 4, 32])
def test_jdbc_reads_open_a_bounded_number_of_connections(n):
    recorder = Recorder()
    jdbc_scan(recorder, "jdbc:x", "t", RangeSplits("id", 1, 100, 100, n), max_connections=10)
    assert recorder.kwargs.get("predicates", []) == (range_predicates(RangeSplits("id", 1, 100, 100, n)) if n > 1 else [])
    assert recorder.tasks == (10 if n > 1 else None)


class Squares(SourceHandler):
    """A handler with three splits, one of which fails on request."""

    def schema(self):
        return "n BIGINT, square BIGINT"

    def plan_splits(self, start=None, end=None):
        return [{"lo": i * 10, "hi": i * 10 + 10} for i in range(3)]

    def read_split(self, split):
        if self.options.get("fail") == "true" and split["lo"] == 20:
            raise RuntimeError("split cannot be read")
        n = list(range(split["lo"], split["hi"]))
        yield pa.RecordBatch.from_pydict({"n": n, "square": [x * x for x in n]})


def test_user_source(spark):
    from pyspark import cloudpickle

    import tests.test_sources as this_module

    cloudpickle.register_pickle_by_value(this_module)
    register_handler(spark, "squares", Squares)
    df = spark.read.format("squares").load()
    assert df.rdd.getNumPartitions() == 3
    assert df.agg(F.sum("square")).first()[0] == sum(i * i for i in range(30))
    with pytest.raises(PySparkException, match="split cannot be read"):
        spark.read.format("squares").option("fail", "true").load().count()
    with pytest.raises(NotImplementedError):
        Squares({}).latest_offset()


def test_manifest_cells_in_quotes(spark, tmp_path):
    from headgate.sources.manifest import COLUMNS, read_manifest

    names = ['bolt 1/2" hex, long', "two\nlines", "ends in \\", "plain"]
    lines = [",".join(n for n, _, _ in COLUMNS)]
    for i, name in enumerate(names):
        quoted = '"' + name.replace('"', '""') + '"'
        lines.append(f"1,,{i},A,{quoted},1,part,,,,,,")
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    rows, rejects = read_manifest(spark, str(tmp_path / "m.csv"))
    assert {r.part_number: r.nomenclature for r in rows.collect()} == {str(i): n for i, n in enumerate(names)}
    assert rejects.count() == 0


def test_manifest_is_as_one_reader_would_read_it(spark, tmp_path):
    """Against the CSV reader that takes a file whole, with blocks of a few bytes."""
    import random

    from headgate.session import settings

    pick = random.Random(5)
    cells = ["a", "", '"q"', '"two\nlines"', '"a ""b"", c\n\n"', '5" bolt', '"x"y', " ", '""', '"tail" ', "\\", '"\\"']
    for k in range(4):
        lines = [",".join(pick.choices(cells, k=13 if pick.random() < 0.9 else 5)) for _ in range(60)]
        (tmp_path / f"m{k}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    names = [n for n, _, _ in COLUMNS]
    whole = spark.read.schema(", ".join(f"`{n}` STRING" for n in [*names, "bad"]))
    whole = whole.options(header=True, columnNameOfCorruptRecord="bad", columnPruning=False, escape='"', multiLine=True).csv(str(tmp_path))
    wanted = whole.collect()
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "50", "spark.sql.files.openCostInBytes": "0"}):
        rows, rejects = (df.collect() for df in read_manifest(spark, str(tmp_path)))
    texts = ["revision", "nomenclature", "type"]
    strip = lambda x: (x or "").strip()
    assert sorted(tuple(strip(r[c]) for c in texts) for r in rows) == sorted(tuple(strip(r[c]) for c in texts) for r in wanted if r.bad is None)
    assert sorted(r.line for r in rejects) == sorted(r.bad for r in wanted if r.bad is not None)
