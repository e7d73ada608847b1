"""Every query outside the llm subpackage against its SQL."""

import compare
import pytest

from tramline.plans import lineage, queries
from tramline.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frequencies(spark):
    """What the queries of regions start from, computed once; coverage_cells compares it with its own SQL."""
    return lineage.cut(queries.frequencies(spark, SF))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name, frequencies, monkeypatch):
    if name.startswith("coverage_") and name != "coverage_cells":
        monkeypatch.setattr(queries, "frequencies", lambda *_: frequencies)
    assert compare.same(spark, SF, QUERIES[name], ORACLES[name]) > 0


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
