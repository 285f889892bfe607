"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from headgate import catalogue
from tests.comparison import differences, oracle

QUERIES = catalogue.QUERIES
SQL = catalogue.ORACLE_SQL


@pytest.fixture(scope="module")
def con(sd):
    return oracle(sd)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(name, spark, sd, con):
    assert differences(QUERIES[name](spark, sd), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(name, spark, sd):
    assert QUERIES[name](spark, sd).count() > 0


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == ["split_id", "lo", "hi", "estimated_rows", "row_count", "min_key", "max_key", "total"]
    rows = report.orderBy("split_id").collect()
    assert [r.split_id for r in rows] == [f"split-{i:04d}" for i in range(4)]
    assert sum(r.row_count for r in rows) == 1500


# The operators of the inventory; each needs at least one query.
INVENTORY = (
    [f"s{i}" for i in range(1, 12)] + [f"p{i}" for i in range(1, 7)] + [f"x{i}" for i in range(1, 6)]
    + [f"i{i}" for i in range(1, 8)] + [f"a{i}" for i in range(1, 7)] + [f"j{i}" for i in range(1, 5)]
    + [f"o{i}" for i in range(1, 4)] + [f"c{i}" for i in range(1, 9)] + [f"y{i}" for i in range(1, 6)]
    + [f"k{i}" for i in range(1, 7)] + [f"g{i}" for i in range(1, 5)] + [f"t{i}" for i in range(1, 7)]
    + [f"m{i}" for i in range(1, 4)] + ["u1"]
)


# A file listing reads no given table; user sources are the user's code. Tests hold them.
UNREGISTERED = ("s8", "s11", "t6")


def test_inventory_is_covered():
    covered = {name.split("_")[0] for name in QUERIES}
    assert covered == set(INVENTORY) - set(UNREGISTERED) and len(INVENTORY) == 75
