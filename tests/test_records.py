"""Quoted records over many blocks against one pass over the whole text."""

import random

import pytest

from headgate.session import settings
from headgate.sources.records import quoted_records


def plain_records(text):
    """One pass, a character at a time."""
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if lines[-1] == "":
        lines.pop()
    records, open_ = [], False
    for line in lines:
        if not open_ and line == "":
            continue
        if open_:
            records[-1] += "\n" + line
        else:
            records.append(line)
        state = "quoted" if open_ else "start"
        for c in line:
            if state == "quoted":
                state = "closed" if c == '"' else "quoted"
            elif c == ",":
                state = "start"
            elif c == '"' and state in ("start", "closed"):
                state = "quoted"
            else:
                state = "within"
        open_ = state == "quoted"
    return records


def read(spark, path, block):
    """Records by file name, in order, each with the mark of the first one."""
    # Blocks of a few bytes: lines and records lie across their ends.
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}):
        rows = quoted_records(spark, path).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.file, r.block, r.at)):
        found.setdefault(r.file.rsplit("/", 1)[1], []).append((r.first, r.value))
    return found


@pytest.mark.parametrize("block", [1, 7, 64, 1_000_000])
def test_records_do_not_depend_on_blocks(spark, tmp_path, block):
    pick = random.Random(block)
    texts = {}
    for k in range(6):
        cells = ['"', '""', ",", "\n", "a", "ä ", "\r\n", '",', ',"', "\n\n", '"x\ny"', "\r"]
        texts[f"f{k}.csv"] = "".join(pick.choices(cells, k=60)) + pick.choice(["", "\n"])
    texts["empty.csv"], texts["blank.csv"] = "", "\n\n\n"
    texts["long.csv"] = 'h\n"' + "\n" * 40 + 'end",x\nlast'
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    found = read(spark, str(tmp_path), block)
    for name, text in texts.items():
        wanted = plain_records(text)
        assert found.get(name, []) == [(k == 0, v) for k, v in enumerate(wanted)], (name, text)


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    text = "".join(f'{i},"a ""{i}""\n\n,b",c" d\n' for i in range(3_000))
    (tmp_path / "m.csv").write_text(text)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}):
        tasks = spark.read.text(str(tmp_path / "m.csv")).rdd.getNumPartitions()
    found = read(spark, str(tmp_path / "m.csv"), 4096)["m.csv"]
    assert tasks > 10 and [v for _, v in found] == plain_records(text) and len(found) == 3_000


def test_lines_stay_where_no_quote_is_left_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n\nh,"x"\n5" bolt,1\n\n"a ""b""",2\n')
    (tmp_path / "b.csv").write_text("h\n1\n")
    (tmp_path / "c.csv").write_text("")
    assert read(spark, str(tmp_path), 3) == {"a.csv": [(True, 'h,"x"'), (False, '5" bolt,1'), (False, '"a ""b""",2')], "b.csv": [(True, "h"), (False, "1")]}
    plan = quoted_records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
