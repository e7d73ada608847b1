"""The registered queries of the subpackage: SQL where it exists, shapes for all."""

import compare
import pytest

from tramline.llm.entry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare.same(spark, SF, QUERIES[name], ORACLES[name]) > 0


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11))


@pytest.mark.parametrize(("name", "source"), [("op1", "documents"), ("op2", "documents"), ("op4", "documents"), ("op5", "documents"), ("op7", "pages"), ("op10", "documents")])
def test_a_row_for_every_row(spark, name, source):
    query = next(f for n, f in QUERIES.items() if n.startswith(name + "_"))
    assert query(spark, SF).count() == spark.read.parquet(f"{SF}/{source}.parquet").count()
