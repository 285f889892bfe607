"""The registered queries over whole small tables."""

import pytest

import __spark_entry__ as entry
from headgate.llm.queries import ORACLE_SQL, QUERIES
from tests.comparison import differences, oracle


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(name, spark, sd):
    assert differences(QUERIES[name](spark, sd), oracle(sd), ORACLE_SQL[name]) == []


ROWS = {"op8_permutation_index": None, "op11_conversation_repair": None, "op12_main_text": "pages"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_a_row_for_each_document(name, spark, sd):
    rows = QUERIES[name](spark, sd)
    table = ROWS.get(name, "documents")
    if name == "op8_permutation_index":
        want = rows.select("query_id").distinct().count() * 20
    elif name == "op11_conversation_repair":
        want = spark.read.parquet(f"{sd}/conversations.parquet").select("conv_id").distinct().count()
    else:
        want = spark.read.parquet(f"{sd}/{table}.parquet").count()
    assert rows.count() == want
