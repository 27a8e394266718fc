"""Every registered query equals its DuckDB transcription (sf0.001)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from nightledger.plans import oracle, registry

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
SQL = oracle.sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= E.queries().keys() and SQL.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["event_dt", "passport", "fio", "phone",
                                                  "event_type", "report_dt"]
    assert df.count() > 0
