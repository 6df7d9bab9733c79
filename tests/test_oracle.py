"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same pairs on sf0.01)."""

import pytest

import __spark_entry__ as E
from tablekit.plans import catalog
from tests.conftest import SF001
from tests.oracle_harness import compare, duck_con

QUERIES = catalog.queries()         # queries that SQL can't express have tests of their own in tests/llm
SQLS = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_con(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in SQLS, f"{name} has no oracle SQL"
    r = compare(spark, con, name, QUERIES[name], SQLS[name], SF001)
    assert r["ok"], r["problems"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["region", "customer_id", "status", "total_spent", "order_count", "regional_rank"]
