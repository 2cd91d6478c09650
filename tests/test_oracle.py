"""Every registered query against its DuckDB oracle (row count, columns, value hash)."""

import pytest

import __spark_entry__ as E
from presslake.plans.job_queries import JOB_QUERIES
from presslake.plans.queries import QUERIES as TABLE_QUERIES

QUERIES = {**TABLE_QUERIES, **JOB_QUERIES}
from tools.compare import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    ok, detail = compare(spark, SF, [name])[name]
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["categorie_clean", "total"] and df.count() > 0
