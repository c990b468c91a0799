"""Every registered query runs; those with SQL give the same rows as DuckDB, at the smallest scale."""

import os

import oracle
import pytest

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def names():
    from garimpo.plans import registry

    return sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", names() if os.path.isdir(FOLDER) else [])
def test_query(spark, con, name):
    from garimpo.plans import registry

    df, sql = registry.queries()[name](spark, FOLDER), registry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
    else:
        assert oracle.compare(df, con, sql) is None


def test_every_sql_has_its_query():
    from garimpo.plans import registry

    assert set(registry.oracle_sql()) <= set(registry.queries())
